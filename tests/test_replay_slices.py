"""Replays of tables with a gap or an outlier in time: a slice is one micro-batch and no row is late."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cardwatch.streaming import jobs
from cardwatch.streaming import sources as ss

T0 = dt.datetime(2024, 1, 1)
DAY = dt.timedelta(days=1)
SCHEMA = "user_id string, event_time timestamp_ntz"


def spread(begin, hours, n):
    return [begin + dt.timedelta(seconds=hours * 3600 * k / n) for k in range(n)]


TABLES = {
    "empty quarter": spread(T0, 24, 700) + spread(T0 + 2 * DAY, 48, 1400),
    "outlier": spread(T0, 96, 2100) + [T0 + 4000 * DAY],
    "one time": [T0] * 1500 + spread(T0 + DAY, 24, 40),
    "two rows": [T0, T0 + DAY],
}


def counted(spark, scratch, times, **options):
    """Rows per hour as the replay counts them, the slices' numbers of files, and their numbers of rows."""
    df = spark.createDataFrame([(f"u{k % 3}", t) for k, t in enumerate(times)], SCHEMA)
    folder = os.path.join(scratch, "s")
    glob, files = ss.stage_in_time_order(df, "event_time", folder, 4, close_after="2 days", **options)
    slices = [os.path.join(folder, d) for d in sorted(os.listdir(folder)) if d.startswith("slice=")][:-1]
    number = [len([f for f in os.listdir(d) if f.endswith(".parquet")]) for d in slices]
    rows = [spark.read.schema(df.schema).parquet(d).count() for d in slices]
    stream = jobs.watermarked(ss.file_stream(spark, glob, df.schema, max_files_per_trigger=files), "1 hour")
    hours = stream.groupBy(F.window("event_time", "1 hour").alias("w")).count().select("w.start", "count")
    q = jobs.start(hours, os.path.join(scratch, "checkpoint"), path=os.path.join(scratch, "out"), available_now=True, shuffle_partitions=2)
    q.awaitTermination()
    assert q.exception() is None
    return sum(r["count"] for r in spark.read.parquet(os.path.join(scratch, "out")).collect()), set(number) == {files}, rows, files


@pytest.mark.parametrize("equal_spans", [False, True])
@pytest.mark.parametrize("name", TABLES)
def test_replay_counts_every_row(spark, scratch, name, equal_spans):
    times = TABLES[name]
    total, even, rows, files = counted(spark, scratch, times, equal_spans=equal_spans)
    assert total == sum(rows) == len(times) and even and all(rows)
    if len(times) > 1000:
        assert files > 1


def test_an_outlier_leaves_slices_of_like_size(spark, scratch):
    _, _, rows, _ = counted(spark, scratch, TABLES["outlier"])
    assert len(rows) == 4 and max(rows) < 1.2 * min(rows)
