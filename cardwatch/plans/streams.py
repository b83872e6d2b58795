"""Registered streaming queries: replay the fixture as a stream, read the sink back.

Each query stages the transactions Spark derives from ``events`` as
time-ordered files (``stage_in_time_order``), runs a Structured Streaming
query with ``availableNow`` into a sink in a fresh folder under the session's
checkpoint directory, and returns the sink read as a batch DataFrame.  The
window, slide and threshold are the batch fixture's (24 h / 4 h / > 6) with a
1 h watermark delay.  A bounded replay ends with one far later row, whose
watermark closes every window and join that is still open, so the results are
those of the whole table.
"""

from __future__ import annotations

import os
import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.session import ensure_checkpoint_dir
from cardwatch.operators import verdict
from cardwatch.sources import codec, commits, fixtures
from cardwatch.streaming import jobs, progress, trailing
from cardwatch.streaming import sources as stream_sources

STREAM_DELAY = "1 hour"
STREAM_SLICES = 4
CLOSE_AFTER = "3 days"  # longer than window, slide and delay together
WINDOW, SLIDE, THRESHOLD = "24 hours", "4 hours", 6
STATE_SHARDS = 256  # keys of the trailing counts a bucket: a replay's batches hold all users
STREAM_CREATED_AT = "2024-02-01 00:00:00"


def _folder(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "cardwatch-streams", f"{name}-{uuid.uuid4().hex[:12]}")


def _staged(spark: SparkSession, frame: DataFrame, name: str, oldest_last: bool = False, close: bool = False,
            closing: DataFrame | None = None) -> DataFrame:
    order = list(range(1, STREAM_SLICES)) + [0] if oldest_last else None
    glob, files = stream_sources.stage_in_time_order(frame, "event_time", _folder(spark, f"stage-{name}"), STREAM_SLICES, order,
                                                     CLOSE_AFTER if close else None, equal_spans=oldest_last, closing=closing)
    return stream_sources.file_stream(spark, glob, frame.schema, max_files_per_trigger=files)


def _txn_stream(spark: SparkSession, d: str, oldest_last: bool = False, close: bool = False) -> DataFrame:
    """The fixture's transactions as a stream; ``close`` for queries that wait for the watermark."""
    return _staged(spark, fixtures.transactions(spark, d), "txn", oldest_last, close)


def _drain(df: DataFrame, name: str, foreach_batch=None, **options):
    spark = df.sparkSession
    base = _folder(spark, name)
    out = os.path.join(base, "out")
    q = jobs.start(df, os.path.join(base, "checkpoint"), path=None if foreach_batch else out,
                   foreach_batch=foreach_batch, available_now=True,
                   shuffle_partitions=spark.sparkContext.defaultParallelism, **options)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")
    return q, out


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# ----------------------------------------------------------------- queries
def q_stream_decode(spark, d):
    """JSON records (key, value, broker timestamp) -> typed wire fields + parsed event time."""
    t = fixtures.transactions(spark, d)
    kv = t.select(F.col("user_id").alias("key"), codec.json_value().alias("value"), "event_time")
    raw = _staged(spark, kv, "json")
    raw = raw.withColumn("timestamp", jobs.as_instant("event_time")).drop("event_time")
    dec = codec.with_event_time(codec.decode(raw, ingest_time="timestamp"))
    dec = dec.withColumn("ingest_time", jobs.as_wall_clock("ingest_time"))
    _, out = _drain(dec, "decode")
    return _read(spark, out)


def q_stream_stateless(spark, d):
    s = jobs.score(_txn_stream(spark, d))
    _, out = _drain(s.select("transaction_id", "stateless_fraud", "fraud_rule", "fraud_confidence",
                             "fraud_reason"), "stateless")
    return _read(spark, out)


def q_stream_velocity_windows(spark, d):
    w = jobs.velocity_windows(jobs.watermarked(_txn_stream(spark, d, close=True), STREAM_DELAY), WINDOW, SLIDE, THRESHOLD)
    _, out = _drain(w, "velocity-windows")
    return _read(spark, out)


def q_stream_rapid_use(spark, d):
    """Rapid use per transaction as the stream goes: keyed list state, a count as soon as the watermark makes it final."""
    r = trailing.rapid_use(jobs.watermarked(_txn_stream(spark, d, close=True), STREAM_DELAY), bucket="7 days", shards=STATE_SHARDS)
    _, out = _drain(r, "rapid-use", rocksdb=True)
    return _read(spark, out).select("transaction_id", "user_id", "rapid_count", "rapid_use")


def q_stream_velocity_trailing(spark, d):
    """The trailing 24 h count per transaction as the stream goes."""
    r = trailing.trailing(jobs.watermarked(_txn_stream(spark, d, close=True), STREAM_DELAY), WINDOW, THRESHOLD, bucket="7 days", shards=STATE_SHARDS)
    _, out = _drain(r, "velocity-trailing", rocksdb=True)
    return _read(spark, out).select("transaction_id", "user_id", "trailing_count", "trailing_fraud")


def _alerts_sink(path: str):
    from cardwatch.sources import sinks

    def write(batch, batch_id):
        sinks.insert_if_absent(batch, path)
    return write


def q_stream_velocity_alerts(spark, d):
    a = jobs.velocity_alerts(jobs.watermarked(_txn_stream(spark, d, close=True), STREAM_DELAY), WINDOW, SLIDE, THRESHOLD)
    base = _folder(spark, "velocity-alerts-table")
    _drain(a, "velocity-alerts", foreach_batch=_alerts_sink(base))
    return _read(spark, base)


def _run_pipeline(spark, d):
    v = jobs.verdicts(jobs.for_tables(jobs.watermarked(_txn_stream(spark, d, close=True), STREAM_DELAY)), WINDOW, SLIDE, THRESHOLD)
    base = _folder(spark, "pipeline-tables")
    txn_path, alerts_path = os.path.join(base, "transactions"), os.path.join(base, "fraud_alerts")
    created = F.lit(STREAM_CREATED_AT).cast("timestamp_ntz")
    _drain(v, "pipeline", foreach_batch=jobs.pipeline_writer(txn_path, alerts_path, created_at=created))
    return txn_path, alerts_path


def _doubles(df: DataFrame) -> DataFrame:
    from cardwatch.plans.catalog import _doubles as to_doubles
    return to_doubles(df)


def q_stream_transactions_table(spark, d):
    txn_path, _ = _run_pipeline(spark, d)
    return _doubles(_read(spark, txn_path).drop("event_date"))


def q_stream_alerts_table(spark, d):
    _, alerts_path = _run_pipeline(spark, d)
    return _doubles(_read(spark, alerts_path).drop("event_date"))


def q_stream_current_alerts(spark, d):
    """Two speeds: stateless alerts at once, final verdicts later, merged by transaction."""
    created = F.lit(STREAM_CREATED_AT).cast("timestamp_ntz")
    early_path = os.path.join(_folder(spark, "early-alerts"), "table")
    _drain(jobs.early_alerts(_txn_stream(spark, d)), "early-alerts",
           foreach_batch=jobs.alerts_writer(early_path, created_at=created))
    _, alerts_path = _run_pipeline(spark, d)
    merged = verdict.current_alerts(_read(spark, alerts_path).drop("event_date"),
                                    _read(spark, early_path).drop("event_date"))
    return _doubles(merged)


def q_stream_early_alerts(spark, d):
    """Stateless alerts written the moment each transaction is scored (no watermark wait)."""
    created = F.lit(STREAM_CREATED_AT).cast("timestamp_ntz")
    path = os.path.join(_folder(spark, "early-alerts"), "table")
    _drain(jobs.early_alerts(_txn_stream(spark, d)), "early-alerts-only",
           foreach_batch=jobs.alerts_writer(path, created_at=created))
    return _doubles(_read(spark, path).drop("event_date"))


def q_stream_late_data(spark, d):
    """The oldest slice arrives last: all its rows are behind the watermark and dropped."""
    w = jobs.velocity_windows(jobs.watermarked(_txn_stream(spark, d, oldest_last=True, close=True), STREAM_DELAY),
                              WINDOW, SLIDE, THRESHOLD)
    _, out = _drain(w, "late-data")
    return _read(spark, out)


def q_stream_progress(spark, d):
    """Input rows of a run, summed over all its batches by a listener."""
    watched = progress.watch(spark)
    try:
        w = jobs.velocity_windows(jobs.watermarked(_txn_stream(spark, d, oldest_last=True), STREAM_DELAY),
                                  WINDOW, SLIDE, THRESHOLD)
        q, _ = _drain(w, "progress")
        return progress.totals(spark, watched, q)
    finally:
        spark.streams.removeListener(watched)


def q_stream_late_records(spark, d):
    """The oldest slice arrives last: the sink keeps each of its transactions as late, with its stateless verdict."""
    timed = jobs.watermarked(_txn_stream(spark, d, oldest_last=True, close=True), STREAM_DELAY)
    base = _folder(spark, "late-records")
    paths = {k: os.path.join(base, k) for k in ("transactions", "alerts", "late", "commits")}
    created = F.lit(STREAM_CREATED_AT).cast("timestamp_ntz")
    rows = jobs.with_arrivals(jobs.verdicts(jobs.for_tables(timed), WINDOW, SLIDE, THRESHOLD), timed)
    checkpoint = os.path.join(_folder(spark, "late-records-checkpoint"))
    q = jobs.start(rows, checkpoint, available_now=True, shuffle_partitions=spark.sparkContext.defaultParallelism,
                   foreach_batch=jobs.pipeline_writer(paths["transactions"], paths["alerts"], created_at=created, checkpoint=checkpoint,
                                                      commits_path=paths["commits"], late_path=paths["late"]))
    _finish([q])
    late = jobs.committed(spark, paths["late"], paths["commits"])
    return _doubles(late.select("transaction_id", "user_id", "amount", "event_time", "final_is_fraud", "final_rule", "fraud_confidence"))


def _odd_batches_twice(write, log: commits.Commits):
    """``write`` with every other batch coming again, as if the driver had died before its commit."""

    def twice(batch, batch_id):
        if batch_id % 2 == 0:
            write(batch, batch_id)
            return
        batch = batch.persist()  # else the second write would run the stream's joins and save their state again
        try:
            write(batch, batch_id)
            log.revoke(commits.stream_id(batch.sparkSession), batch_id)
            write(batch, batch_id)
        finally:
            batch.unpersist()
    return twice


def q_stream_fraud_metrics(spark, d):
    """The hourly metrics kept up to date by the stream's batches, some of which are replayed after a lost commit."""
    timed = jobs.for_tables(jobs.watermarked(_txn_stream(spark, d, close=True), STREAM_DELAY))
    base = _folder(spark, "metrics")
    paths = {k: os.path.join(base, k) for k in ("transactions", "alerts", "commits", "metrics", "checkpoint")}
    write = jobs.pipeline_writer(paths["transactions"], paths["alerts"], created_at=F.lit(STREAM_CREATED_AT).cast("timestamp_ntz"),
                                 commits_path=paths["commits"], metrics_path=paths["metrics"])
    q = jobs.start(jobs.verdicts(timed, WINDOW, SLIDE, THRESHOLD), paths["checkpoint"], available_now=True,
                   foreach_batch=_odd_batches_twice(write, commits.Commits(spark, paths["commits"])),
                   shuffle_partitions=spark.sparkContext.defaultParallelism)
    _finish([q])
    return jobs.current_metrics(spark, paths["metrics"], paths["commits"])


def q_stream_high_amount_asof(spark, d):
    """The high-amount rule on the stream, with the thresholds in force at each transaction's time."""
    from cardwatch.plans.catalog import asof_signals
    _, out = _drain(asof_signals(_txn_stream(spark, d)), "asof")
    return _read(spark, out)


def q_stream_state_audit(spark, d):
    """What a stream that was not closed still holds: its state, read from the checkpoint."""
    w = jobs.velocity_windows(jobs.watermarked(_txn_stream(spark, d), STREAM_DELAY), WINDOW, SLIDE, 0)
    base = _folder(spark, "state-audit")
    checkpoint = os.path.join(base, "checkpoint")
    q = jobs.start(w, checkpoint, path=os.path.join(base, "out"), available_now=True, rocksdb=True,
                   shuffle_partitions=spark.sparkContext.defaultParallelism)
    _finish([q])
    held = progress.state(spark, checkpoint)
    return held.select(F.col("key.user_id").alias("user_id"), jobs.as_wall_clock(F.col("key.window.start")).alias("window_start"),
                       jobs.as_wall_clock(F.col("key.window.end")).alias("window_end"), F.col("value.count").alias("txn_count"))


def q_stream_latency(spark, d):
    """Quantiles of the time from a transaction to its record's arrival, from log-spaced bins kept per batch and merged."""
    late_by = (fixtures.event_number(F.col("transaction_id")) * 7919) % 90_011
    t = _txn_stream(spark, d)
    t = t.withColumn("ingest_time", F.timestamp_add("MILLISECOND", late_by.cast("int"), F.col("event_time")))
    base = _folder(spark, "latency")
    paths = {k: os.path.join(base, k) for k in ("bins", "commits", "checkpoint")}
    q = jobs.start(t.select("event_time", "ingest_time"), paths["checkpoint"], available_now=True,
                   foreach_batch=progress.latency_writer(paths["bins"], paths["commits"]))
    _finish([q])
    return progress.latency(jobs.committed(spark, paths["bins"], paths["commits"]))


def _finish(queries) -> None:
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"stream {q.name} failed: {q.exception()}")


def _timed_records(spark, d) -> DataFrame:
    """``defective_records`` beside the times of their events: (event_id, key, value, event_time).

    A record and a time meet by event id.  Where no id is repeated that is the time of the record's own row, and rows need not meet.
    """
    from cardwatch.plans.catalog import defective_records

    records = defective_records(spark, d, keep_event_id=True, keep=["event_time"]).where(F.col("event_id").isNotNull())
    if records.groupBy("event_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).isEmpty():
        return records
    return records.drop("event_time").join(records.select("event_id", "event_time"), "event_id")


def _json_run(spark, d, name: str) -> dict[str, str]:
    """Good and defective JSON records, the oldest slice last, through the whole pipeline; the folders it wrote.

    Records are keyed by event number, which a bad record must be traced by in
    its kept text.  A last record far later closes everything open.
    """
    t = fixtures.transactions(spark, d, keep_event_id=True)
    records = _timed_records(spark, d)
    value = F.concat(F.expr("substring(value, 1, length(value) - 1)"), F.lit(',"device_id":"E'), F.col("event_id").cast("string"), F.lit('"}'))
    kv = records.select("key", F.when(F.col("event_id") % 40 == 13, F.concat(F.lit("not json "), F.col("event_id").cast("string")))
                        .otherwise(value).alias("value"), "event_time")
    newest = t.agg(F.max("event_time")).first()[0] + timedelta(days=3)
    last = (t.limit(1).withColumn("transaction_id", F.lit("close"))
            .withColumn("timestamp", F.lit(newest.strftime("%Y-%m-%dT%H:%M:%S+00:00")))
            .select(F.col("user_id").alias("key"), codec.json_value().alias("value"),
                    F.lit(newest.isoformat(sep=" ")).cast("timestamp_ntz").alias("event_time")))
    raw = _staged(spark, kv, name, oldest_last=True, closing=last)
    base = _folder(spark, name)
    paths = {k: os.path.join(base, k) for k in ("transactions", "alerts", "quarantine", "late", "commits")}
    _finish(jobs.run(raw.drop("event_time"), paths["transactions"], paths["alerts"], os.path.join(base, "checkpoints"),
                     quarantine_path=paths["quarantine"], late_path=paths["late"], commits_path=paths["commits"],
                     window=WINDOW, slide=SLIDE, threshold=THRESHOLD, delay=STREAM_DELAY, available_now=True,
                     state_partitions=spark.sparkContext.defaultParallelism))
    return paths


def q_stream_pipeline_audit(spark, d):
    """Good, defective and late JSON records through the whole pipeline: where each record ended."""
    paths = _json_run(spark, d, "audit")
    number = F.coalesce(F.nullif(F.regexp_extract("raw_value", r'"device_id":"E([0-9]+)"\}$', 1), F.lit("")),
                        F.nullif(F.regexp_extract("raw_value", r"^not json ([0-9]+)$", 1), F.lit("")))
    bad = jobs.committed(spark, paths["quarantine"], paths["commits"]).select(
        number.cast("bigint").alias("event_id"), F.lit("quarantine").alias("place"), "violations")
    odd_id = F.regexp_extract("transaction_id", "^txn-([0-9]+)$", 1)
    event = F.when(odd_id != "", odd_id.try_cast("bigint")).otherwise(fixtures.event_number(F.col("transaction_id")))
    for place in ("transactions", "late"):
        rows = jobs.committed(spark, paths[place], paths["commits"])
        bad = bad.unionByName(rows.select(event.alias("event_id"), F.lit(place).alias("place"), F.lit(None).cast("string").alias("violations")))
    return bad


def q_stream_pipeline_counters(spark, d):
    """The live counters at the end of that run."""
    return progress.counters(spark, _json_run(spark, d, "counters")["commits"])


STREAM_QUERIES = {
    "stream_decode": q_stream_decode,
    "stream_stateless": q_stream_stateless,
    "stream_velocity_windows": q_stream_velocity_windows,
    "stream_velocity_alerts": q_stream_velocity_alerts,
    "stream_rapid_use": q_stream_rapid_use,
    "stream_velocity_trailing": q_stream_velocity_trailing,
    "stream_transactions_table": q_stream_transactions_table,
    "stream_alerts_table": q_stream_alerts_table,
    "stream_current_alerts": q_stream_current_alerts,
    "stream_early_alerts": q_stream_early_alerts,
    "stream_late_data": q_stream_late_data,
    "stream_progress": q_stream_progress,
    "stream_fraud_metrics": q_stream_fraud_metrics,
    "stream_high_amount_asof": q_stream_high_amount_asof,
    "stream_state_audit": q_stream_state_audit,
    "stream_latency": q_stream_latency,
    "stream_late_records": q_stream_late_records,
    "stream_pipeline_counters": q_stream_pipeline_counters,
    "stream_pipeline_audit": q_stream_pipeline_audit,
}
