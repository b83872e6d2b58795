"""Streaming sources: Kafka, file folders, and replay of a table as an ordered stream."""

from __future__ import annotations

import time as clock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.functions import epoch_micros, from_epoch_micros, interval_micros
from cardwatch.sources import storage


def kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str, starting_offsets: str = "latest",
                 fail_on_data_loss: bool = False, options: dict | None = None) -> DataFrame:
    """Subscribe to one topic; rows are (key, value, topic, partition, offset, timestamp, ...).

    Needs the spark-sql-kafka package on the cluster; decode ``value`` with
    :func:`cardwatch.sources.codec.decode`.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, path_glob_filter: str | None = None,
                options: dict | None = None) -> DataFrame:
    """New files of a folder as a stream (fixed schema, no inference)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if path_glob_filter:
        reader = reader.option("pathGlobFilter", path_glob_filter)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path)


def stage_in_time_order(df: DataFrame, time_col: str, folder: str, slices: int = 4, order: list[int] | None = None,
                        close_after: str | None = None, equal_spans: bool = False, closing: DataFrame | None = None) -> tuple[str, int]:
    """Write ``df`` as slices of about as many rows each, oldest first; returns the glob to stream and the files per slice.

    The file source orders files by modification time, so slices whose files are
    dated one after another and read with ``maxFilesPerTrigger`` = files per slice replay
    the events in time order, a slice per micro-batch: no row is late to the
    watermark, whatever the delay.  Slices are bounded by quantiles of the
    time, or with ``equal_spans`` by equal spans of it; a slice without rows is
    left out.  ``df`` is read twice, for the time column's statistics and to
    write all slices in one job, every slice as the same number
    of files: empty ones are added to a slice that has fewer.  This is a replay
    harness for tests and back-fills on storage that can date files; a live
    deployment reads Kafka.  ``order`` dates the slices in another
    order (e.g. oldest last, to replay late data).  ``close_after`` adds a last
    slice of one row that much later than all others: its watermark closes
    every window and join that the replay left open, and it is never emitted
    itself.  ``closing`` gives that last slice's rows instead.
    """
    spark = df.sparkSession
    time = epoch_micros(time_col)
    n = max(1, int(slices))
    cuts = F.percentile_approx(time, F.array(*[F.lit((k + 1) / n) for k in range(n)]))
    lo, hi, rows, quantiles = df.agg(F.min(time), F.max(time), F.count("*"), cuts).first()
    if lo is None:
        raise ValueError("nothing to stage: the table is empty")
    if equal_spans:
        part = F.least(F.floor((time - F.lit(lo)) * F.lit(n) / F.lit(hi - lo + 1)), F.lit(n - 1))
    else:
        part = F.lit(0)
        for bound in sorted({q for q in quantiles if q < hi}):
            part = part + F.when(time > bound, 1).otherwise(0)
    files = max(1, min(spark.sparkContext.defaultParallelism, rows // (64 * n)))
    dealt = df.withColumn("slice", part.cast("int"))
    place = F.col("slice") * files + F.pmod(F.xxhash64(*df.columns), F.lit(files)).cast("int")
    dealt.repartitionById(n * files, place.cast("int")).write.mode("errorifexists").partitionBy("slice").parquet(folder)
    if close_after:
        end = from_epoch_micros(F.lit(hi + interval_micros(close_after)))
        closing = df.limit(1).withColumn(time_col, end).select(*df.columns)
    if closing is not None:
        closing.select(*df.columns).coalesce(1).write.mode("errorifexists").parquet(f"{folder}/slice={n}")
    # files are dated a second apart, in the order of the replay, none in the future
    date = int(clock.time()) * 1000 - 1000 * (n * files + 16)
    for i in [*(order if order is not None else range(n)), n]:
        path = f"{folder}/slice={i}"
        if not storage.exists(spark, path):
            continue
        for _ in range(files - len(storage.data_files(spark, path)) if i < n else 0):  # a task without rows writes no file
            spark.createDataFrame([], df.schema).coalesce(1).write.mode("append").parquet(path)
        for name in sorted(storage.data_files(spark, path)):
            date += 1000
            storage.set_time(spark, name, date)
    return f"{folder}/slice=*", files
