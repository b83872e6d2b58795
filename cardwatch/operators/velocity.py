"""Velocity operators: bursts of activity per user in event time.

* ``windows``       sliding-window counts (``F.window`` + groupBy); batch or stream.
* ``join_windows``  the original's left interval join, one row per (transaction,
                    burst window) -- keeps its fan-out, as a named operator.
* ``flag``          one row per transaction: inside any burst window?  max count.
* ``trailing``      count of the user's events in the trailing range of each event.

Scale notes
-----------
``windows`` relies on partial (map-side) aggregation, so a user holding a
third of all rows only contributes one partial count per (window, map task).
``flag``/``join_windows`` never replicate transactions: the burst windows
(already filtered, small) are expanded to the panes they cover, where a pane is
``gcd(window, slide)`` long, and transactions equi-join on (user, pane).  A hot
user is spread over its panes instead of landing in one task.  ``trailing``
partitions by (user, time bucket of one range), with a copy of each row in the
next bucket and a marker at its range's start (payload nulled in both); its
windows are running sums, so the work is linear in the rows, and no group holds
more than two buckets of one user's rows.  ``trailing_split`` also splits those.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch import schema as S
from cardwatch.functions import epoch_micros, from_epoch_micros, interval_micros


def windows(df: DataFrame, window: str = S.VELOCITY_WINDOW, slide: str = S.VELOCITY_SLIDE,
            threshold: int = S.VELOCITY_MAX_TRANSACTIONS, user: str = "user_id",
            time: str = "event_time") -> DataFrame:
    """(user, window_start, window_end, txn_count) for windows with more than ``threshold`` events.

    Events are counted per (user, pane) first; only these counts, not the
    events, go to the window/slide windows that contain their pane.
    """
    g, _ = _pane_us(window, slide)
    w_us, s_us = interval_micros(window), interval_micros(slide)
    panes = df.groupBy(F.col(user), pane_of(F.col(time), g).alias("_pane")).agg(F.count(F.lit(1)).alias("_n"))
    begin = F.col("_pane") * F.lit(g)
    last = F.floor(begin / F.lit(s_us))
    first = F.ceil((begin + F.lit(g - w_us)) / F.lit(s_us))
    counts = (panes.select(user, "_n", F.explode(F.sequence(first, last)).alias("_k"))
              .groupBy(user, "_k").agg(F.sum("_n").alias("txn_count")).where(F.col("txn_count") > threshold))
    start = F.col("_k") * F.lit(s_us)
    return counts.select(F.col(user), from_epoch_micros(start).alias("window_start"),
                         from_epoch_micros(start + F.lit(w_us)).alias("window_end"), F.col("txn_count"))


def stream_windows(df: DataFrame, window: str = S.VELOCITY_WINDOW, slide: str = S.VELOCITY_SLIDE,
                   threshold: int = S.VELOCITY_MAX_TRANSACTIONS, user: str = "user_id",
                   time: str = "event_time") -> DataFrame:
    """:func:`windows` of a watermarked stream: one stateful ``F.window`` count, as append mode needs it."""
    counts = (df.groupBy(F.window(F.col(time), window, slide).alias("window"), F.col(user))
              .agg(F.count(F.lit(1)).alias("txn_count")))
    return (counts.where(F.col("txn_count") > threshold)
            .select(F.col(user), F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), F.col("txn_count")))


def _pane_us(window: str, slide: str) -> tuple[int, int]:
    w, s = interval_micros(window), interval_micros(slide)
    g = gcd(w, s)
    return g, w // g


def pane_of(time: Column, pane_us: int) -> Column:
    return F.floor(epoch_micros(time) / F.lit(pane_us))


def burst_panes(bursts: DataFrame, window: str = S.VELOCITY_WINDOW, slide: str = S.VELOCITY_SLIDE,
                user: str = "user_id") -> DataFrame:
    """Each burst window expanded to the panes it covers: (user, pane, window_start, txn_count)."""
    g, n = _pane_us(window, slide)
    first = pane_of(F.col("window_start"), g)
    return bursts.select(F.col(user), "window_start", "window_end", "txn_count",
                         F.explode(F.sequence(first, first + F.lit(n - 1))).alias("_pane"))


def join_windows(txn: DataFrame, bursts: DataFrame | None = None, window: str = S.VELOCITY_WINDOW,
                 slide: str = S.VELOCITY_SLIDE, threshold: int = S.VELOCITY_MAX_TRANSACTIONS,
                 user: str = "user_id", time: str = "event_time", how: str = "left") -> DataFrame:
    """Transactions joined to every burst window containing them (original fan-out).

    Equivalent to ``txn.user = b.user AND b.start <= txn.time < b.start + window``
    but as an equi-join on (user, pane).
    """
    if bursts is None:
        bursts = windows(txn, window, slide, threshold, user, time)
    g, _ = _pane_us(window, slide)
    panes = burst_panes(bursts, window, slide, user).select(
        F.col(user).alias("_vu"), "_pane", F.col("window_start").alias("velocity_window_start"), "txn_count")
    t = txn.withColumn("_pane", pane_of(F.col(time), g))
    cond = (t[user] == panes["_vu"]) & (t["_pane"] == panes["_pane"])
    return t.join(panes, cond, how).drop("_pane", "_vu")


def flag(txn: DataFrame, bursts: DataFrame | None = None, window: str = S.VELOCITY_WINDOW,
         slide: str = S.VELOCITY_SLIDE, threshold: int = S.VELOCITY_MAX_TRANSACTIONS,
         user: str = "user_id", time: str = "event_time") -> DataFrame:
    """One row per transaction with ``velocity_fraud`` and ``txn_count`` (max over its burst windows)."""
    if bursts is None:
        bursts = windows(txn, window, slide, threshold, user, time)
    g, _ = _pane_us(window, slide)
    flagged = (burst_panes(bursts, window, slide, user)
               .groupBy(F.col(user).alias("_vu"), "_pane").agg(F.max("txn_count").alias("txn_count")))
    t = txn.drop("txn_count", "velocity_fraud").withColumn("_pane", pane_of(F.col(time), g))
    out = t.join(flagged, (t[user] == flagged["_vu"]) & (t["_pane"] == flagged["_pane"]), "left")
    return (out.drop("_vu").drop(flagged["_pane"]).drop("_pane")
            .withColumn("velocity_fraud", F.col("txn_count").isNotNull()))


def flag_by_expansion(txn: DataFrame, window: str = S.VELOCITY_WINDOW, slide: str = S.VELOCITY_SLIDE,
                      threshold: int = S.VELOCITY_MAX_TRANSACTIONS, user: str = "user_id",
                      time: str = "event_time", key: str = "transaction_id") -> DataFrame:
    """Alternative to :func:`flag` for comparison: expand each transaction to its
    windows, count per (user, window) with partial aggregates, take the max per
    transaction.  Replicates rows window/slide times; kept for the bench."""
    w_us, s_us = interval_micros(window), interval_micros(slide)
    n = -(-w_us // s_us)
    last = F.floor(epoch_micros(F.col(time)) / F.lit(s_us))
    starts = (txn.select(key, user, time, F.explode(F.sequence(last - F.lit(n - 1), last)).alias("_ws"))
              .where(epoch_micros(F.col(time)) < F.col("_ws") * F.lit(s_us) + F.lit(w_us)))
    bursts = (starts.groupBy(user, "_ws").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > threshold))
    per_txn = starts.join(bursts, [user, "_ws"]).groupBy(key).agg(F.max("_c").alias("txn_count"))
    return (txn.drop("txn_count", "velocity_fraud").join(per_txn, key, "left")
            .withColumn("velocity_fraud", F.col("txn_count").isNotNull()))


def trailing(df: DataFrame, range_: str = S.VELOCITY_WINDOW, threshold: int = S.VELOCITY_MAX_TRANSACTIONS,
             user: str = "user_id", time: str = "event_time", lower_inclusive: bool = True,
             count_col: str = "trailing_count", flag_col: str = "trailing_fraud") -> DataFrame:
    """``COUNT(*) OVER (PARTITION BY user ORDER BY time RANGE BETWEEN range PRECEDING AND CURRENT ROW)``.

    ``lower_inclusive=False`` makes the range half-open, ``(t - range, t]``.
    Rows with equal time are peers and count each other, as in SQL.
    """
    w_us = interval_micros(range_)
    lower = w_us if lower_inclusive else w_us - 1
    payload = [c for c in df.columns if c != user]
    us = epoch_micros(F.col(time))
    rows = df.withColumn("_us", us).withColumn("_b", F.floor(F.col("_us") / F.lit(w_us)))
    # Three rows per event: itself, its copy for the next bucket, and a marker at the start of its range.
    entry = lambda bk, pos, kind: F.struct(bk.alias("bk"), pos.alias("pos"), F.lit(kind).alias("kind"))
    entries = F.array(entry(F.col("_b"), F.col("_us"), 0), entry(F.col("_b") + 1, F.col("_us"), 1),
                      entry(F.col("_b"), F.col("_us") - F.lit(lower), 2))
    own = F.col("_e.kind") == 0
    exp = rows.select(F.col(user), "_us", *payload, F.explode(entries).alias("_e")).select(
        F.col(user), "_us", F.col("_e.bk").alias("_bk"), F.col("_e.pos").alias("_pos"), F.col("_e.kind").alias("_kind"),
        *[F.when(own, F.col(c)).alias(c) for c in payload])
    # Running counts only (no frame is counted again per row): events up to here, and events before here.
    run = Window.partitionBy(user, "_bk").orderBy("_pos")
    one = F.when(F.col("_kind") < 2, 1).otherwise(0)
    upto = F.sum(one).over(run.rangeBetween(Window.unboundedPreceding, 0))
    before = F.coalesce(F.sum(one).over(run.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # The marker's number meets its event's by the event time, inside the same partitions.
    same = Window.partitionBy(user, "_bk", "_us")
    out = (exp.withColumns({"_upto": upto, "_before": before})
           .withColumn("_skipped", F.max(F.when(F.col("_kind") == 2, F.col("_before"))).over(same))
           .where(F.col("_kind") == 0).withColumn(count_col, F.col("_upto") - F.col("_skipped")))
    out = out.withColumn(flag_col, F.col(count_col) > threshold)
    return out.select(*df.columns, count_col, flag_col)


def rapid_use(df: DataFrame, user: str = "user_id", time: str = "event_time") -> DataFrame:
    """Simulator label: at least 8 events by the user within the last 60 s (open lower bound)."""
    return trailing(df, S.RAPID_USE_WINDOW, S.RAPID_USE_MIN_EVENTS - 1, user, time, lower_inclusive=False,
                    count_col="rapid_count", flag_col="rapid_use")


def trailing_split(df: DataFrame, range_: str = S.VELOCITY_WINDOW, threshold: int = S.VELOCITY_MAX_TRANSACTIONS,
                   user: str = "user_id", time: str = "event_time", lower_inclusive: bool = True,
                   bucket: str | None = None, count_col: str = "trailing_count",
                   flag_col: str = "trailing_fraud") -> DataFrame:
    """:func:`trailing` for keys too hot for one range of their events in one task.

    Time is cut into buckets of ``bucket`` (default: a quarter of the range,
    never more than the range).  For an event at ``t`` in bucket ``b`` whose
    window starts at ``lo`` in bucket ``bl`` (``b-K`` or ``b-K-1`` with
    ``K = range // bucket``), the count is

        events of b up to t  +  events of the buckets strictly between bl and b
        +  events of bl from lo on.

    1. events are counted per (user, time) (peers once, partial aggregation);
    2. the middle term is a range sum over per-(user, bucket) totals, a table
       sized by time span / bucket, ordered by bucket number;
    3. the first and last terms are ranks inside one (user, bucket) group,
       for the event and for its window's start;
    4. the terms are added per (user, time) and joined back to the rows.

    No group holds more than about two buckets of one user's distinct times,
    however large that user's share, at the price of more shuffles than
    :func:`trailing`.  Same result, row for row.
    """
    w_us = interval_micros(range_)
    span = w_us if lower_inclusive else w_us - 1
    b_us = interval_micros(bucket) if bucket else max(1, span // 4)
    if b_us > span:
        raise ValueError("bucket must not be longer than the range")
    k = span // b_us
    us = epoch_micros(F.col(time))
    bk = lambda c: F.floor(c / F.lit(b_us))
    pts = df.groupBy(F.col(user).alias("_u"), us.alias("_t")).agg(F.count(F.lit(1)).alias("_n"))

    totals = pts.groupBy("_u", bk(F.col("_t")).alias("_b")).agg(F.sum("_n").alias("_cnt"))
    by_bucket = Window.partitionBy("_u").orderBy("_b")
    near = F.sum("_cnt").over(by_bucket.rangeBetween(-(k - 1), -1)) if k > 1 else F.lit(None)
    far = F.sum("_cnt").over(by_bucket.rangeBetween(-k, -1))
    middle = totals.select("_u", "_b", F.coalesce(near, F.lit(0)).cast("bigint").alias("_mid_k"),
                           F.coalesce(far, F.lit(0)).cast("bigint").alias("_mid_k1"))

    lo = F.col("_t") - F.lit(span)
    ev = pts.select("_u", bk(F.col("_t")).alias("_b"), F.col("_t").alias("_pos"), F.col("_n").alias("_w"),
                    F.lit(True).alias("_is_event"), F.col("_t").alias("_key"),
                    (bk(lo) == bk(F.col("_t")) - F.lit(k)).alias("_near"))
    qs = pts.select("_u", bk(lo).alias("_b"), lo.alias("_pos"), F.lit(0).cast("bigint").alias("_w"),
                    F.lit(False).alias("_is_event"), F.col("_t").alias("_key"), F.lit(None).cast("boolean"))
    both = ev.unionByName(qs.withColumnRenamed(qs.columns[-1], "_near")).join(middle, ["_u", "_b"], "left")
    in_bucket = Window.partitionBy("_u", "_b").orderBy("_pos")
    upto = F.sum("_w").over(in_bucket.rangeBetween(Window.unboundedPreceding, 0))
    below = F.coalesce(F.sum("_w").over(in_bucket.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.sum("_w").over(Window.partitionBy("_u", "_b"))
    mid = F.when(F.col("_near"), F.col("_mid_k")).otherwise(F.col("_mid_k1"))
    part = F.when(F.col("_is_event"), upto + mid).otherwise(whole - below)
    counts = both.select("_u", "_key", part.alias("_v")).groupBy("_u", "_key").agg(F.sum("_v").alias(count_col))
    out = df.join(counts, (df[user] == counts["_u"]) & (us == counts["_key"]), "left")
    return (out.drop("_u", "_key").withColumn(flag_col, F.col(count_col) > threshold)
            .select(*df.columns, count_col, flag_col))
