"""Live counters of streaming queries (events, alerts, rates, late rows, latency).

``counters`` reads the pipeline's own totals; ``observe`` adds named metrics that Spark computes inside the micro-batch
(no extra job); ``Totals`` sums them over all batches of a run; ``progress_rows``
flattens ``StreamingQuery.recentProgress``, which holds the latest batches only.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from cardwatch.functions import epoch_micros, round_half_up
from cardwatch.sources.commits import QUERY, Commits, stream_id

PROGRESS_SCHEMA = ("batch_id long, num_input_rows long, input_rows_per_second double, "
                   "processed_rows_per_second double, watermark string, rows_dropped_by_watermark long, "
                   "state_rows long, events long, alerts long, max_latency_ms long")


def observe(df: DataFrame, name: str = "live", ingest_time: str | None = "ingest_time") -> DataFrame:
    """Attach per-batch counters: events, alerts, max ingest-to-processing latency (ms)."""
    metrics = [F.count(F.lit(1)).alias("events"),
               F.count_if(F.coalesce(F.col("final_is_fraud"), F.lit(False))).alias("alerts")]
    if ingest_time and ingest_time in df.columns:
        lat = F.unix_millis(F.current_timestamp()) - F.unix_millis(F.col(ingest_time))
        metrics += [F.max(lat).alias("max_latency_ms"), F.avg(lat).alias("avg_latency_ms")]
    return df.observe(name, *metrics)


def progress_rows(query: StreamingQuery, observed: str = "live") -> list[dict]:
    """One dict per recent micro-batch."""
    out = []
    for p in query.recentProgress:
        d = p if isinstance(p, dict) else p.jsonValue
        ops = d.get("stateOperators", [])
        obs = (d.get("observedMetrics") or {}).get(observed) or {}
        if hasattr(obs, "asDict"):  # PySpark hands observed metrics over as a Row
            obs = obs.asDict()
        out.append({
            "batch_id": d.get("batchId"),
            "num_input_rows": d.get("numInputRows"),
            "input_rows_per_second": d.get("inputRowsPerSecond"),
            "processed_rows_per_second": d.get("processedRowsPerSecond"),
            "watermark": (d.get("eventTime") or {}).get("watermark"),
            "rows_dropped_by_watermark": sum(int(o.get("numRowsDroppedByWatermark", 0)) for o in ops),
            "state_rows": sum(int(o.get("numRowsTotal", 0)) for o in ops),
            "events": obs.get("events"),
            "alerts": obs.get("alerts"),
            "max_latency_ms": obs.get("max_latency_ms"),
        })
    return out


def progress_frame(spark: SparkSession, query: StreamingQuery, observed: str = "live") -> DataFrame:
    return spark.createDataFrame(progress_rows(query, observed), PROGRESS_SCHEMA)


class Totals(StreamingQueryListener):
    """Running totals of every query of a session, by run id, over all its batches.

    ``recentProgress`` forgets after a number of batches; a listener sees each
    batch once and keeps one small record per run.
    """

    def __init__(self):
        self.by_run: dict[str, dict] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        self.by_run.setdefault(str(event.runId), {"batches": 0, "input_rows": 0, "late_state_rows_dropped": 0, "events": 0, "alerts": 0})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        t = self.by_run.setdefault(str(p.runId), {"batches": 0, "input_rows": 0, "late_state_rows_dropped": 0, "events": 0, "alerts": 0})
        t["batches"] += 1
        t["input_rows"] += int(p.numInputRows or 0)
        t["late_state_rows_dropped"] += sum(int(o.numRowsDroppedByWatermark or 0) for o in p.stateOperators)
        for row in (p.observedMetrics or {}).values():
            seen = row.asDict()
            t["events"] += int(seen.get("events") or 0)
            t["alerts"] += int(seen.get("alerts") or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def of(self, query: StreamingQuery, wait_s: float = 30.0) -> dict:
        """Totals of a query; for one that has ended, after its last event has arrived."""
        run = str(query.runId)
        until = time.monotonic() + wait_s
        while not query.isActive and run not in self.ended and time.monotonic() < until:
            time.sleep(0.05)
        return dict(self.by_run.get(run, {}))


def watch(spark: SparkSession) -> Totals:
    """Start counting the queries of this session."""
    listener = Totals()
    spark.streams.addListener(listener)
    return listener


def totals(spark: SparkSession, watched: Totals, query: StreamingQuery) -> DataFrame:
    """Run totals: input rows, summed over the query's reads of its sources (a join of a stream with itself reads it twice;
    :func:`counters` counts records once)."""
    t = watched.of(query)
    return spark.createDataFrame([(t.get("input_rows", 0),)], "input_rows long")


COUNTERS = ["records", "quarantined", "events", "alerts", "late"]


def counters(spark: SparkSession, commits_path: str) -> DataFrame:
    """Live counters of the pipeline, one row: records read, quarantined, transactions and alerts in the tables, late transactions.

    They come from the commits, which carry the rows that committed batches
    really added, summed over the pipeline's queries and over all checkpoints
    that wrote to these tables.
    """
    rows = Commits(spark, commits_path).totals(COUNTERS)
    # a stream has one commit file, or for a moment two
    rows = rows.groupBy(QUERY).agg(*[F.max_by(F.col(c), F.col("batch")).alias(c) for c in COUNTERS])
    out = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS])
    return out.withColumn("alert_rate_pct", round_half_up(F.coalesce(F.try_divide(F.lit(100.0) * F.col("alerts"), F.col("events")), F.lit(0.0)), 3))


#: Bins per doubling of the latency: a quantile is at most one part in so many below the exact one.
LATENCY_STEPS = 32


def latency_bin(millis: Column) -> Column:
    """Log-spaced bin of a duration: exact below ``LATENCY_STEPS``, then that many bins per doubling; integers only. Negative counts as 0."""
    v = F.greatest(millis.cast("long"), F.lit(0).cast("long"))
    shift = F.greatest(F.length(F.bin(v)) - F.lit(LATENCY_STEPS.bit_length()), F.lit(0))
    top = F.call_function("shiftright", v, shift)
    return (shift * LATENCY_STEPS + top).cast("long")


def latency_floor(bin_: Column) -> Column:
    """The smallest duration of a bin."""
    shift = F.greatest(F.floor(bin_ / F.lit(LATENCY_STEPS)) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", bin_ - shift * LATENCY_STEPS, shift)


def latency_parts(rows: DataFrame, since: str = "event_time", until: str = "ingest_time") -> DataFrame:
    """(bin, n) of the time between two columns: additive, so parts of a run are merged by adding."""
    at = lambda c: F.unix_millis(c) if dict(rows.dtypes)[c] == "timestamp" else F.floor(epoch_micros(c) / 1000)
    took = at(until) - at(since)
    return rows.where(took.isNotNull()).groupBy(latency_bin(took).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def latency_writer(path: str, commits_path: str, since: str = "event_time", until: str = "ingest_time"):
    """foreachBatch callback keeping each batch's histogram (a few hundred rows at most) in a folder of its own."""
    from cardwatch.sources import sinks

    def write(batch: DataFrame, batch_id: int) -> None:
        query, log = stream_id(batch.sparkSession), Commits(batch.sparkSession, commits_path)
        if log.begin(query, batch_id) == "done":
            return
        sinks.write_batch(latency_parts(batch, since, until), path, query, batch_id)
        log.commit(query, batch_id, {})

    return sinks.foreach_batch_writer(write, persist=False)


def latency(parts: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """One row: ``measured`` and per quantile ``p<percent>_ms``, the floor of the bin that holds the exact one.

    The exact quantile is the value whose rank is ceil(q * n); it is less than
    one part in ``LATENCY_STEPS`` above the floor.  Only bins are ordered, at most some thousands.
    """
    bins = parts.groupBy("bin").agg(F.sum("n").alias("n"))
    upto = bins.withColumn("upto", F.sum("n").over(Window.orderBy("bin"))).withColumn("all", F.sum("n").over(Window.partitionBy()))
    of = [F.min(F.when(F.col("upto") >= F.ceil(F.col("all") * F.lit(q)), F.col("bin"))).alias(f"b{k}") for k, q in enumerate(quantiles)]
    return upto.agg(F.coalesce(F.max("all"), F.lit(0)).alias("measured"), *of).select(
        "measured", *[latency_floor(F.col(f"b{k}")).alias(f"p{q * 100:g}_ms") for k, q in enumerate(quantiles)])


def state(spark: SparkSession, checkpoint: str, name: str | None = None, operator: int = 0) -> DataFrame:
    """What a stream holds between batches: a stateful operator's rows as of the checkpoint's last batch.

    ``name`` is the state variable of an operator with several.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if name:
        reader = reader.option("stateVarName", name)
    return reader.load(checkpoint)
