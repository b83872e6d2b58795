"""Structured Streaming jobs built from the batch operators.

Shapes
------
* ``watermarked``        event time as TIMESTAMP + ``withWatermark`` (late rows drop).
* ``score``              stateless rules: no state, a verdict per row at once.
* ``velocity_windows``   sliding-window counts, append mode: a window is emitted
                         once the watermark passes its end.
* ``velocity_alerts``    transactions inside an emitted burst window (inner
                         stream-stream interval join of transactions and bursts).
* ``verdicts``           one verdict per transaction (left outer interval join):
                         a transaction comes out as soon as a burst window
                         containing it closes, or, with no burst, once the
                         watermark passes ``event_time + window``.
* ``with_arrivals``      verdicts plus the transactions as they arrive, so that the
                         sink can keep those that the joins drop as late.
* ``pipeline_writer``    one query, one ``foreachBatch`` writing the transactions,
                         the alerts and the late transactions, idempotently and
                         with one commit.

The joins chain after the windowed aggregation (``window_time`` carries the
watermark).  Both join keys are (user, pane) with a pane of ``gcd(window,
slide)``: a burst window is exploded into its panes and a transaction lies in
exactly one pane, so a user with a huge share of the events is spread over
its panes rather than one join task, and no transaction row is replicated.
The range condition on the event times lets Spark evict join state.
"""

from __future__ import annotations

import os
from math import gcd
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardwatch import schema as S
from cardwatch.functions import epoch_micros, from_epoch_micros, interval_micros
from cardwatch.operators import rules as R
from cardwatch.operators import quality, tables, velocity, verdict
from cardwatch.plans import reports
from cardwatch.sources import commits, sinks

CONSOLE_COLUMNS = ["transaction_id", "user_id", "amount", "merchant_category", "final_rule", "fraud_confidence"]


def as_instant(col) -> Column:
    """TIMESTAMP_NTZ holding UTC wall-clock time -> TIMESTAMP (no session zone involved)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), c))


def as_wall_clock(col) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ in UTC (the batch tables' event-time type)."""
    c = F.col(col) if isinstance(col, str) else col
    return from_epoch_micros(F.unix_micros(c))


def watermarked(txn: DataFrame, delay: str = S.WATERMARK_DELAY, time: str = "event_time") -> DataFrame:
    """``withWatermark`` needs a TIMESTAMP column; NTZ event times are converted first."""
    if dict(txn.dtypes)[time] == "timestamp_ntz":
        txn = txn.withColumn(time, as_instant(time))
    return txn.withWatermark(time, delay)


def score(txn: DataFrame, rules: R.RuleSet | None = None) -> DataFrame:
    """Stateless rules; the same column expressions as in batch."""
    return R.apply_rules(txn, rules)


def velocity_windows(txn: DataFrame, window: str = S.VELOCITY_WINDOW, slide: str = S.VELOCITY_SLIDE,
                     threshold: int = S.VELOCITY_MAX_TRANSACTIONS) -> DataFrame:
    """Burst windows (user_id, window_start, window_end, txn_count) of a watermarked stream."""
    out = velocity.stream_windows(txn, window, slide, threshold)
    return out.select("user_id", as_wall_clock("window_start").alias("window_start"),
                      as_wall_clock("window_end").alias("window_end"), "txn_count")


def _pane(window: str, slide: str) -> tuple[int, int]:
    w, s = interval_micros(window), interval_micros(slide)
    g = gcd(w, s)
    return g, w // g


def burst_panes(txn: DataFrame, window: str, slide: str, threshold: int) -> DataFrame:
    """Emitted burst windows, one row per pane: (b_user, b_pane, window_time, txn_count)."""
    g, n = _pane(window, slide)
    counts = (txn.groupBy(F.window("event_time", window, slide), F.col("user_id"))
              .agg(F.count(F.lit(1)).alias("txn_count"))
              .where(F.col("txn_count") > threshold))
    first = F.floor(F.unix_micros(F.col("window.start")) / F.lit(g))
    return counts.select(F.col("user_id").alias("b_user"), F.window_time("window").alias("window_time"),
                         "txn_count", F.explode(F.sequence(first, first + F.lit(n - 1))).alias("b_pane"))


def _join_bursts(txn: DataFrame, window: str, slide: str, threshold: int, how: str) -> DataFrame:
    g, _ = _pane(window, slide)
    bursts = burst_panes(txn, window, slide, threshold)
    t = txn.withColumn("_pane", F.floor(F.unix_micros(F.col("event_time")) / F.lit(g)))
    cond = ((t["user_id"] == bursts["b_user"]) & (t["_pane"] == bursts["b_pane"])
            & (t["event_time"] <= bursts["window_time"])
            & (t["event_time"] > bursts["window_time"] - F.expr(f"INTERVAL {window}")))
    return t.join(bursts, cond, how).drop("_pane", "b_user", "b_pane", "window_time")


def velocity_alerts(txn: DataFrame, window: str = S.VELOCITY_WINDOW, slide: str = S.VELOCITY_SLIDE,
                    threshold: int = S.VELOCITY_MAX_TRANSACTIONS) -> DataFrame:
    """Transactions inside a burst window, as alert rows (one per matching window; the sink dedups)."""
    j = _join_bursts(txn, window, slide, threshold, "inner")
    scored = score(j).withColumn("velocity_fraud", F.lit(True))
    return verdict.alerts(verdict.resolve(scored).withColumn("event_time", as_wall_clock("event_time")))


def verdicts(txn: DataFrame, window: str = S.VELOCITY_WINDOW, slide: str = S.VELOCITY_SLIDE,
             threshold: int = S.VELOCITY_MAX_TRANSACTIONS, mode: str = "reference") -> DataFrame:
    """Rules + velocity + resolution for a watermarked stream (rows per matching window; see ``one_per_transaction``)."""
    j = _join_bursts(txn, window, slide, threshold, "left")
    scored = score(j).withColumn("velocity_fraud", F.col("txn_count").isNotNull())
    return verdict.resolve(scored, mode, window).withColumn("event_time", as_wall_clock("event_time"))


#: Wire fields that no rule, count or table reads.
UNREAD = ["device_id", "ip_address", "latitude", "longitude", "is_fraud"]


def for_tables(txn: DataFrame) -> DataFrame:
    """``txn`` without the fields that would only lie in the verdict join's state and the sink's batch."""
    return txn.drop(*UNREAD)


def read_once(rows: DataFrame) -> DataFrame:
    """``rows`` dealt out by all their columns, for a query that uses them several times.

    As no use can leave a column out below the exchange, all uses have the same
    one there, and Spark runs what lies below (scan, decoding, checks) once a batch.
    """
    return rows.repartition(F.xxhash64(*rows.columns))


def with_arrivals(verdict_rows: DataFrame, txn: DataFrame) -> DataFrame:
    """Verdicts, and beside them every arriving transaction as it came (``_arrived``, no verdict yet).

    Spark drops rows behind the watermark inside the joins; the arrivals let the
    sink of the same query tell which ones these are (:func:`pipeline_writer`).
    """
    came = txn.withColumn("event_time", as_wall_clock("event_time")).withColumn("_arrived", F.lit(True))
    return verdict_rows.withColumn("_arrived", F.lit(False)).unionByName(came, allowMissingColumns=True)


def one_per_transaction(batch: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Collapse a micro-batch's window fan-out: the highest burst count per transaction.

    Arrivals (:func:`with_arrivals`) have no fan-out: each different row of them stays.
    """
    best = F.max_by(F.struct(*[F.col(c) for c in batch.columns]), F.coalesce(F.col("txn_count"), F.lit(-1)))
    keys = [F.col(key)]
    if "_arrived" in batch.columns:
        keys += [F.col("_arrived"), F.when(F.col("_arrived"), F.xxhash64(*batch.columns)).alias("_row")]
    return batch.groupBy(*keys).agg(best.alias("_r")).select("_r.*")


def pipeline_writer(transactions_path: str, alerts_path: str, created_at=None,
                    partition_by: str | None = "event_date", id_fixes_date: bool = False,
                    jdbc: dict | None = None, key_index: bool = False, commits_path: str | None = None,
                    late_path: str | None = None, checkpoint: str | None = None, rules: R.RuleSet | None = None,
                    show: bool = False, metrics_path: str | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch callback for :func:`verdicts`: both tables from one persisted batch.

    Each table is keyed on ``transaction_id`` and written with
    :func:`cardwatch.sources.sinks.insert_if_absent`, so a micro-batch that is
    replayed after a failure adds nothing twice.  ``id_fixes_date`` tells that an
    id is never sent again with another date, so only the batch's dates are
    read; ``key_index`` reads only files that may hold one of the batch's ids.
    ``jdbc`` (url, properties) writes to database tables of the given
    names instead of to files, both in one transaction.

    ``commits_path`` makes the tables one atomic sink: rows carry stream and
    batch, a commit file follows the last table, and :func:`committed` reads the
    rows of committed batches.  The commit also has the running totals of rows
    added: ``events``, ``alerts``, ``late``.  (With ``jdbc`` the tables are
    atomic by themselves; a batch whose merge ended but whose commit file is
    missing is counted 0 when replayed.)

    For a stream :func:`with_arrivals`, transactions behind the watermark, which
    the joins drop, go to ``late_path`` with the verdict of the stateless rules:
    the sink reads the batch's watermark from the query's ``checkpoint`` and
    takes the arrivals that Spark's own rule (event time <= watermark of the
    batch before) drops, so every transaction is either decided or late.
    ``show`` prints the batch's fraud rows.

    ``metrics_path`` (with ``commits_path``) keeps the hourly metrics up to
    date: the additive parts of the rows that the batch added to the
    transactions table, read back from the files it wrote, in a folder of the
    batch's own.  :func:`current_metrics` adds up those of committed batches.
    """

    def put(rows: DataFrame, target: str, time: str, mark: tuple[str, int, bool] | None) -> int:
        parts = None
        if partition_by:
            rows = rows.withColumn(partition_by, F.to_date(time))
            parts = [partition_by]
        own = 0
        if mark:
            query, number, again = mark
            rows = commits.marked(rows, query, number)
            stored = sinks.stored_table(rows, target) if again else None
            if stored is not None:  # what an earlier try of this batch has added already
                own = stored.where((F.col(commits.QUERY) == query) & (F.col(commits.BATCH) == number)).count()
        return own + sinks.insert_if_absent(rows, target, partition_by=parts, prune_by=partition_by if id_fixes_date else None,
                                            order_by=[time], key_index=key_index, distinct_keys=True)  # by one_per_transaction

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = commits.stream_id(spark)
        log = commits.Commits(spark, commits_path) if commits_path else None
        began = log.begin(query, batch_id) if log else "new"
        if began == "done":
            return
        rows = batch
        if "_arrived" in batch.columns:
            behind = epoch_micros("event_time") <= F.lit(commits.watermarks(spark, checkpoint, batch_id) * 1000)
            rows = batch.where(~F.col("_arrived") | behind)
        one = one_per_transaction(rows).persist()
        counts = {"events": 0, "alerts": 0, "late": 0}
        try:
            if not one.isEmpty():
                decided = one.where(~F.col("_arrived")).drop("_arrived") if "_arrived" in one.columns else one
                fraud = verdict.alerts(decided)
                if show:
                    decided.where("final_is_fraud").select(*CONSOLE_COLUMNS).show(truncate=False)
                txn_rows, alert_rows = tables.to_transactions_table(decided, created_at), tables.to_alerts_table(fraud, created_at)
                if jdbc:
                    counts["events"], counts["alerts"] = sinks.jdbc_merge(
                        [(txn_rows, transactions_path), (alert_rows, alerts_path)], jdbc["url"], jdbc.get("properties"),
                        order_by=[["event_time"], ["alert_time"]])
                else:
                    mark = (query, batch_id, began == "again") if log else None
                    counts["events"] = put(txn_rows, transactions_path, "event_time", mark)
                    counts["alerts"] = put(alert_rows, alerts_path, "alert_time", mark)
                    if mark and metrics_path:
                        added = commits.marked(txn_rows.withColumn(partition_by, F.to_date("event_time")) if partition_by else txn_rows, query, batch_id)
                        added = sinks.stored_table(added, transactions_path).where((F.col(commits.QUERY) == query) & (F.col(commits.BATCH) == batch_id))
                        if partition_by:
                            days = [r[0] for r in txn_rows.select(F.to_date("event_time")).distinct().collect()]  # days of one batch
                            added = added.where(F.col(partition_by).isin(days))
                        sinks.write_batch(reports.metric_parts(added), metrics_path, query, batch_id)
                if "_arrived" in one.columns and late_path:
                    missed = one.where("_arrived").select(*[c for c in one.columns if c in S.TRANSACTION_FIELDS], "event_time")
                    missed = verdict.resolve(score(missed, rules).withColumn("velocity_fraud", F.lit(False)))
                    counts["late"] = sinks.write_batch(tables.to_transactions_table(missed, created_at), late_path, query, batch_id, kept=True)
        finally:
            one.unpersist()
        if log:
            log.commit(query, batch_id, counts)

    return sinks.foreach_batch_writer(write, persist=False)


def current_metrics(spark, metrics_path: str, commits_path: str) -> DataFrame:
    """The hourly fraud metrics as of the last committed batch, from the batches' parts instead of the transactions."""
    return reports.metrics_of(reports.merged_metrics(committed(spark, metrics_path, commits_path)))


def committed(spark, path: str, commits_path: str) -> DataFrame:
    """The rows of a table of the pipeline that belong to committed batches."""
    return commits.Commits(spark, commits_path).visible(spark.read.parquet(path))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start(df: DataFrame, checkpoint: str, *, path: str | None = None, fmt: str = "parquet",
          foreach_batch: Callable[[DataFrame, int], None] | None = None, output_mode: str = "append",
          processing_time: str | None = S.TRIGGER_INTERVAL, available_now: bool = False,
          query_name: str | None = None, shuffle_partitions: int | None = None, rocksdb: bool = False) -> StreamingQuery:
    """Start a query with a required checkpoint; ``available_now`` drains the input and stops.

    ``shuffle_partitions`` sets the number of state partitions of this query
    only.  A stream keeps the number it first started with (it is recorded in
    the checkpoint) and adaptive execution does not coalesce it, so size it
    to the cores that will run the stream rather than the batch default.
    ``rocksdb`` keeps this query's state in RocksDB, on the executors' disks
    rather than in their memory, with the changes logged to the checkpoint.
    """
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt).option("path", path)
    own = {}
    if shuffle_partitions is not None:
        own["spark.sql.shuffle.partitions"] = str(int(shuffle_partitions))
    if rocksdb:
        own["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
        own["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    conf = df.sparkSession.conf
    before = {k: conf.get(k, None) for k in own}
    for k, v in own.items():
        conf.set(k, v)
    try:
        return w.start()
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def console(df: DataFrame, columns: list[str] | None = None, processing_time: str = S.TRIGGER_INTERVAL) -> StreamingQuery:
    """Debug sink: selected columns of fraud rows to stdout, untruncated."""
    cols = columns or CONSOLE_COLUMNS
    if "final_is_fraud" in df.columns:
        df = df.where(F.col("final_is_fraud"))
    return (df.select(*cols).writeStream.format("console").option("truncate", "false")
            .outputMode("append").trigger(processingTime=processing_time).start())


def await_all(queries: list[StreamingQuery], timeout_s: float | None = None) -> None:
    """Wait until one of ``queries`` ends; a failure stops the others and is re-raised.

    Terminations of other queries in the session are ignored.  Returns
    quietly when ``timeout_s`` passes with all of them still running.
    """
    import time

    if not queries:
        return
    from pyspark.sql import SparkSession

    streams = SparkSession.getActiveSession().streams
    deadline = None if timeout_s is None else time.monotonic() + timeout_s
    while all(q.isActive for q in queries):
        left = None if deadline is None else deadline - time.monotonic()
        if left is not None and left <= 0:
            return
        streams.resetTerminated()
        if not all(q.isActive for q in queries):
            break
        try:
            streams.awaitAnyTermination(10 if left is None else max(0.1, min(10.0, left)))
        except Exception:  # some query failed; ours are inspected below
            pass
    failed = [q for q in queries if not q.isActive and q.exception() is not None]
    if failed:
        for q in queries:
            if q.isActive:
                q.stop()
        raise RuntimeError(f"streaming query {failed[0].name or failed[0].id} failed: {failed[0].exception()}")


def early_alerts(txn: DataFrame, rules: R.RuleSet | None = None) -> DataFrame:
    """Stateless alerts at once (no watermark wait): the rule's own name as ``final_rule``.

    The fast half of the two-speed design; :func:`verdicts` gives the final
    word later, and :func:`cardwatch.operators.verdict.current_alerts`
    merges the two tables.
    """
    s = score(txn, rules).where(F.col("stateless_fraud"))
    s = s.withColumn("final_rule", F.col("fraud_rule"))
    if dict(s.dtypes).get("event_time") == "timestamp":
        s = s.withColumn("event_time", as_wall_clock("event_time"))
    return verdict.alerts(s.withColumn("final_is_fraud", F.lit(True)))


def alerts_writer(path: str, created_at=None, partition_by: str | None = "event_date") -> Callable[[DataFrame, int], None]:
    """foreachBatch callback writing alert rows to an alerts table, keyed on ``transaction_id``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = tables.to_alerts_table(batch, created_at)
        parts = None
        if partition_by:
            rows = rows.withColumn(partition_by, F.to_date("alert_time"))
            parts = [partition_by]
        sinks.insert_if_absent(rows, path, partition_by=parts, order_by=["alert_time"], key_index=True)

    return sinks.foreach_batch_writer(write)


def quarantine_writer(path: str, commits_path: str | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch callback for validated records: blocked ones (text and violations) go to ``path``.

    Each batch of each stream has a folder of its own: a replayed batch
    overwrites it, so nothing is there twice, and a stream with a new checkpoint
    touches nothing that an earlier one wrote.  With ``commits_path`` the
    stream's totals of ``records`` read and ``quarantined`` are kept.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = commits.stream_id(spark)
        log = commits.Commits(spark, commits_path) if commits_path else None
        if log and log.begin(query, batch_id) == "done":
            return
        read = Observation()
        bad = batch.observe(read, F.count(F.lit(1)).alias("n")).where(quality.blocked()).persist()
        try:
            bad.write.format("noop").mode("overwrite").save()  # one pass over the batch, counted in its last stage
            n = sinks.write_batch(bad, path, query, batch_id, kept=True)
        finally:
            bad.unpersist()
        if log:
            log.commit(query, batch_id, {"records": int(read.get["n"] or 0), "quarantined": n})

    return sinks.foreach_batch_writer(write, persist=False)


def run(raw: DataFrame, transactions_path: str, alerts_path: str, checkpoint_root: str, *,
        quarantine_path: str | None = None, late_path: str | None = None, commits_path: str | None = None,
        window: str = S.VELOCITY_WINDOW, slide: str = S.VELOCITY_SLIDE,
        threshold: int = S.VELOCITY_MAX_TRANSACTIONS, delay: str = S.WATERMARK_DELAY,
        processing_time: str = S.TRIGGER_INTERVAL, available_now: bool = False,
        console_debug: bool = False, state_partitions: int | None = None,
        early_alerts_path: str | None = None, id_fixes_date: bool = False, key_index: bool = True,
        jdbc: dict | None = None) -> list[StreamingQuery]:
    """The whole pipeline on a raw (key, value, timestamp) stream, e.g. :func:`kafka_stream`.

    decode -> validate -> event time -> watermark -> rules + velocity -> one
    ``foreachBatch`` writing both tables.  Every record ends in one place: the
    transactions table; ``late_path`` (valid, but behind the watermark); or, with
    a blocking violation, ``quarantine_path`` with its text.  Both default to
    folders beside the transactions table, as does ``commits_path``: read the
    tables with :func:`committed`, the live counters with
    :func:`cardwatch.streaming.progress.counters`.  ``jdbc``
    writes the two tables to a database (see :func:`pipeline_writer`).
    Each query has its own folder under ``checkpoint_root`` (shared storage).
    ``state_partitions`` fixes the verdict query's state partitions (see
    :func:`start`).  ``early_alerts_path`` adds the stateless alert stream
    (alerts at once; merge with :func:`verdict.current_alerts`).
    ``console_debug`` prints the verdicts' fraud rows, bursts included, from the
    same query.  Wait on the result with :func:`await_all`.
    """
    from cardwatch.sources import codec

    beside = checkpoint_root if jdbc else transactions_path.rstrip("/")
    name = "/" if jdbc else "_"
    quarantine_path = quarantine_path or f"{beside}{name}quarantine"
    late_path = late_path or f"{beside}{name}late"
    commits_path = commits_path or f"{beside}{name}commits"
    decoded = codec.with_event_time(codec.decode(raw, keep_raw=True))
    checked = quality.validate(decoded, only=quality.blocking())
    good = decoded.where(~quality.blocking()).drop("raw_value")
    timed = watermarked(read_once(good.withColumn("event_time", as_instant("event_time"))), delay)
    checkpoint = os.path.join(checkpoint_root, "verdicts")
    writer = pipeline_writer(transactions_path, alerts_path, id_fixes_date=id_fixes_date, key_index=key_index, jdbc=jdbc,
                             commits_path=commits_path, late_path=late_path, checkpoint=checkpoint, show=console_debug)
    queries = [start(with_arrivals(verdicts(for_tables(timed), window, slide, threshold), timed), checkpoint, foreach_batch=writer,
                     processing_time=processing_time, available_now=available_now, query_name="verdicts",
                     shuffle_partitions=state_partitions)]
    if early_alerts_path:
        queries.append(start(early_alerts(good), os.path.join(checkpoint_root, "early_alerts"),
                             foreach_batch=alerts_writer(early_alerts_path),
                             processing_time=processing_time, available_now=available_now,
                             query_name="early_alerts"))
    queries.append(start(checked, os.path.join(checkpoint_root, "quarantine"),
                         foreach_batch=quarantine_writer(quarantine_path, commits_path),
                         processing_time=processing_time, available_now=available_now, query_name="quarantine"))
    return queries
