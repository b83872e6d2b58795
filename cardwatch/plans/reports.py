"""Analyst reports over the ``transactions`` and ``fraud_alerts`` tables.

Money is summed as DECIMAL(12,2) (exact, order-independent) and only cast to
double at the end; rates use integer counts; rounding is half-up in doubles
(``round_half_up``).  All reports are grouped aggregates (partial aggregation
before the shuffle); the only un-partitioned windows run over per-bucket
tables whose size is bounded by the time span, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions import epoch_micros, floor_time, interval_micros, round_half_up


def _fraud() -> Column:
    return F.coalesce(F.col("final_is_fraud"), F.lit(False))


def _money(col: Column) -> Column:
    return col.cast("double")


def metric_parts(txn_table: DataFrame, bucket: str = "1 hour") -> DataFrame:
    """Additive parts of :func:`fraud_metrics`: counts and exact sums per hour, of any share of the rows."""
    return txn_table.groupBy(floor_time("event_time", bucket).alias("hour")).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(_fraud()).alias("fraud_count"),
        F.sum("amount").cast("decimal(38,2)").alias("_vol"),
        F.sum(F.when(_fraud(), F.col("amount")).otherwise(F.lit(0).cast("decimal(12,2)"))).cast("decimal(38,2)").alias("_fvol"))


def merged_metrics(parts: DataFrame) -> DataFrame:
    """The parts of several shares of the rows added up."""
    return parts.groupBy("hour").agg(*[F.sum(c).alias(c) for c in ("total_transactions", "fraud_count")],
                                     *[F.sum(c).cast("decimal(38,2)").alias(c) for c in ("_vol", "_fvol")])


def fraud_metrics(txn_table: DataFrame, ascending: bool = False, bucket: str = "1 hour") -> DataFrame:
    """Per hour: total, fraud count, fraud rate % (3 dp), total and fraud volume."""
    return metrics_of(metric_parts(txn_table, bucket), ascending)


def metrics_of(g: DataFrame, ascending: bool = False) -> DataFrame:
    """:func:`fraud_metrics` from its (merged) parts."""
    out = g.select(
        "hour", "total_transactions", "fraud_count",
        round_half_up(F.lit(100.0) * F.col("fraud_count") / F.col("total_transactions"), 3).alias("fraud_rate_pct"),
        _money(F.col("_vol")).alias("total_volume_usd"), _money(F.col("_fvol")).alias("fraud_volume_usd"))
    return out.orderBy(F.col("hour").asc() if ascending else F.col("hour").desc())


def rule_performance(alerts_table: DataFrame) -> DataFrame:
    """Per final rule: alert count, avg confidence (3 dp), avg amount (2 dp), first/last alert."""
    g = alerts_table.groupBy("final_rule").agg(
        F.count(F.lit(1)).alias("alert_count"),
        F.sum("fraud_confidence").alias("_sc"), F.count("fraud_confidence").alias("_nc"),
        F.sum("amount").alias("_sa"), F.count("amount").alias("_na"),
        F.min("alert_time").alias("first_seen"), F.max("alert_time").alias("last_seen"))
    return g.select(
        "final_rule", "alert_count",
        round_half_up(F.col("_sc").cast("double") / F.col("_nc").cast("double"), 3).alias("avg_confidence"),
        round_half_up(F.col("_sa").cast("double") / F.col("_na").cast("double"), 2).alias("avg_amount"),
        "first_seen", "last_seen").orderBy(F.col("alert_count").desc(), "final_rule")


def summary(txn_table: DataFrame, as_of) -> DataFrame:
    """One row: totals, fraud rate, volumes and mean age in seconds relative to ``as_of``."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    age_us = epoch_micros(as_of) - epoch_micros(F.col("event_time"))
    g = txn_table.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(_fraud()).alias("fraud_count"),
        F.sum("amount").alias("_vol"),
        F.sum(F.when(_fraud(), F.col("amount")).otherwise(F.lit(0).cast("decimal(12,2)"))).alias("_fvol"),
        F.sum(age_us).alias("_age"))
    return g.select(
        "total_transactions", "fraud_count",
        round_half_up(F.lit(100.0) * F.col("fraud_count") / F.col("total_transactions"), 3).alias("fraud_rate_pct"),
        round_half_up(_money(F.col("_vol")), 2).alias("total_volume_usd"),
        round_half_up(_money(F.col("_fvol")), 2).alias("fraud_volume_usd"),
        round_half_up(F.col("_age").cast("double") / F.col("total_transactions").cast("double")
                      / F.lit(1e6), 1).alias("avg_age_seconds"))


SUMMARY_METRICS = ["total_transactions", "fraud_count", "fraud_rate_pct", "total_volume_usd",
                   "fraud_volume_usd", "avg_age_seconds"]


def summary_long(summary_df: DataFrame) -> DataFrame:
    """The summary row as (metric, value) pairs."""
    casted = summary_df.select(*[F.col(c).cast("double").alias(c) for c in SUMMARY_METRICS])
    return casted.unpivot([], SUMMARY_METRICS, "metric", "value")


def amount_sample(txn_table: DataFrame, max_amount: float = 2000.0, limit: int = 5000,
                  order_by: str = "transaction_id") -> DataFrame:
    """The notebook's sample: rows under ``max_amount``, first ``limit`` by ``order_by``.

    The limit is the feature (a sample for a chart); the order makes it
    deterministic.  Spark plans it as a top-k (TakeOrderedAndProject).
    """
    return (txn_table.where(F.col("amount") < F.lit(max_amount))
            .select("transaction_id", F.col("amount").cast("double").alias("amount"), "final_is_fraud",
                    *([order_by] if order_by not in ("transaction_id", "amount", "final_is_fraud") else []))
            .orderBy(order_by, "transaction_id").limit(limit)
            .select("transaction_id", "amount", "final_is_fraud"))


def amount_histogram(txn_table: DataFrame, bins: int = 60, max_amount: float | None = 2000.0,
                     label: str = "final_is_fraud") -> DataFrame:
    """Equal-width histogram per label over that label's own [min, max]; last bin closed.

    The input is first counted per (label, amount) with partial aggregation,
    so the ranges (a window over that small table) and the binning work on one
    row per distinct amount (cents in the transactions table), not per
    transaction, and the input is read once.
    """
    rows = txn_table
    if max_amount is not None:
        rows = rows.where(F.col("amount") < F.lit(max_amount))
    pts = (rows.select(F.col(label), F.col("amount").cast("double").alias("a"))
           .groupBy(label, "a").agg(F.count(F.lit(1)).alias("n")))
    own = Window.partitionBy(label)
    j = pts.withColumns({"lo": F.min("a").over(own), "hi": F.max("a").over(own)})
    span = F.col("hi") - F.col("lo")
    b = F.when(span > 0, F.least(F.floor((F.col("a") - F.col("lo")) * F.lit(float(bins)) / span),
                                 F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    g = j.groupBy(label, b.alias("bin"), "lo", "hi").agg(F.sum("n").alias("txn_count"))
    width = span / F.lit(float(bins))
    return g.select(label, "bin",
                    (F.col("lo") + F.col("bin") * width).alias("bin_low"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_high"),
                    "txn_count")


def alerts_by_rule(alerts: DataFrame) -> DataFrame:
    return (alerts.groupBy("final_rule").agg(F.count(F.lit(1)).alias("alert_count"))
            .orderBy(F.col("alert_count").desc(), "final_rule"))


def top_users(txn_table: DataFrame, k: int = 10) -> DataFrame:
    """Users with any fraud, most fraud first (user id breaks ties), top ``k``."""
    g = txn_table.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_txn"),
        F.count_if(_fraud()).alias("fraud_txn"),
        F.sum(F.when(_fraud(), F.col("amount")).otherwise(F.lit(0).cast("decimal(12,2)"))).alias("_famt"))
    return (g.where(F.col("fraud_txn") > 0)
            .select("user_id", "total_txn", "fraud_txn",
                    round_half_up(F.lit(100.0) * F.col("fraud_txn") / F.col("total_txn"), 1).alias("fraud_rate_pct"),
                    round_half_up(_money(F.col("_famt")), 2).alias("fraud_amount_usd"))
            .orderBy(F.col("fraud_txn").desc(), F.col("user_id").asc()).limit(k))


def running_totals(txn_table: DataFrame, bucket: str = "1 hour") -> DataFrame:
    """Cumulative sent / fraud / fraud % / events per second at the end of each time bucket.

    Raw rows are aggregated per bucket first; the running sums then run over
    that bucket table only.
    """
    per = txn_table.groupBy(floor_time("event_time", bucket).alias("bucket_start")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(_fraud()).alias("_f"),
        F.min("event_time").alias("_first"))
    w = Window.orderBy("bucket_start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = interval_micros(bucket)
    out = per.select(
        "bucket_start",
        F.sum("_n").over(w).alias("sent"),
        F.sum("_f").over(w).alias("fraud"),
        F.min("_first").over(w).alias("_t0"))
    elapsed_s = (epoch_micros(F.col("bucket_start")) + F.lit(step) - epoch_micros(F.col("_t0"))).cast("double") / F.lit(1e6)
    return out.select(
        "bucket_start", "sent", "fraud",
        round_half_up(F.lit(100.0) * F.col("fraud") / F.col("sent"), 3).alias("fraud_pct"),
        round_half_up(F.col("sent").cast("double") / elapsed_s, 3).alias("events_per_s"))


def register_views(txn_table: DataFrame, alerts_table: DataFrame, prefix: str = "") -> list[str]:
    """Named views over the two tables, as the warehouse defines them (session-scoped).

    ``fraud_metrics`` (hourly, newest first) and ``rule_performance``; query
    them with ``spark.sql``.  Returns the view names.
    """
    names = [prefix + "fraud_metrics", prefix + "rule_performance"]
    fraud_metrics(txn_table).createOrReplaceTempView(names[0])
    rule_performance(alerts_table).createOrReplaceTempView(names[1])
    return names
