"""Keyed trailing counts, state read back, latency bins, metrics kept by batches, thresholds by validity, review write-back."""

import datetime as dt
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch.operators import feedback, rules, velocity
from cardwatch.plans import reports
from cardwatch.sources import storage
from cardwatch.streaming import jobs, progress, trailing
from cardwatch.streaming import sources as ss

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "transaction_id string, user_id string, event_time timestamp_ntz"


def stream_of(spark, folder, files):
    for k, rows in enumerate(files):
        frame = spark.createDataFrame([(i, u, T0 + dt.timedelta(seconds=s)) for i, u, s in rows], SCHEMA)
        frame.coalesce(1).write.parquet(os.path.join(folder, f"f={k:03d}"))
    return jobs.watermarked(ss.file_stream(spark, os.path.join(folder, "f=*"), spark.createDataFrame([], SCHEMA).schema, max_files_per_trigger=1),
                            "30 seconds")


def drain(df, base):
    q = jobs.start(df, os.path.join(base, "ck"), path=os.path.join(base, "out"), available_now=True, shuffle_partitions=2, rocksdb=True)
    q.awaitTermination()
    assert q.exception() is None
    return os.path.join(base, "ck")


@pytest.mark.parametrize("lower_inclusive", [True, False])
def test_trailing_counts_equal_the_range_frame(spark, scratch, lower_inclusive):
    rng = np.random.default_rng(3)
    seconds = np.sort(rng.integers(0, 900, 240)).tolist() + [3_580 + k for k in range(60)]  # the last ones cross the hour
    rows = [(f"t{k}", "hot" if k % 3 else f"u{k % 4}", int(s)) for k, s in enumerate(seconds)]
    # files overlap in time by less than the delay, so order within them does not matter
    files = [list(reversed(rows[k:k + 50])) for k in range(0, len(rows), 50)] + [[("close", "z", 50_000)]]
    got = trailing.trailing(stream_of(spark, os.path.join(scratch, "in"), files), "60 seconds", 6, lower_inclusive, bucket="20 minutes")
    checkpoint = drain(got, scratch)
    batch = spark.createDataFrame([(i, u, T0 + dt.timedelta(seconds=s)) for i, u, s in rows], SCHEMA)
    want = velocity.trailing(batch, "60 seconds", 6, lower_inclusive=lower_inclusive)
    cols = ["transaction_id", "user_id", "event_time", "trailing_count", "trailing_fraud"]
    out = spark.read.parquet(os.path.join(scratch, "out")).select(*cols)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.select(*cols).collect()))
    # after the last timer only the row that closed all others is held
    held = progress.state(spark, checkpoint, "rows")
    assert held.select("key.user_id").distinct().collect()[0][0] == "z" and held.count() == 1


def test_shards_hold_many_users_under_few_keys(spark, scratch):
    rng = np.random.default_rng(5)
    seconds = np.sort(rng.integers(0, 5_000, 300)).tolist()
    users = [None, "", "hot", *[f"u{k}" for k in range(40)]]
    rows = [(f"t{k}" if k % 9 else None, users[k % 3 if k % 2 else k % len(users)], int(s)) for k, s in enumerate(seconds)]
    files = [rows[k:k + 60] for k in range(0, len(rows), 60)] + [[("close", "z", 50_000)]]
    stream = stream_of(spark, os.path.join(scratch, "in"), files)
    drain(trailing.trailing(stream, "60 seconds", 6, bucket="20 minutes", shards=3), scratch)
    batch = spark.createDataFrame([(i, u, T0 + dt.timedelta(seconds=s)) for i, u, s in rows], SCHEMA)
    cols = ["transaction_id", "user_id", "event_time", "trailing_count", "trailing_fraud"]
    got = spark.read.parquet(os.path.join(scratch, "out")).select(*cols).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, velocity.trailing(batch, "60 seconds", 6).select(*cols).collect()))


def test_counts_of_far_apart_users_and_times():
    user, us = np.array([0, 1, 1, 2**20, 0]), np.array([-2**60, 5, 5, 6, 2**60])
    assert trailing.counts_of(user, us, np.array([True, True, False, True, True]), 10).tolist() == [1, 2, 1, 1]


def test_a_bucket_holds_a_whole_range(spark, scratch):
    with pytest.raises(ValueError):
        trailing.trailing(stream_of(spark, os.path.join(scratch, "in"), [[("a", "u", 0)]]), "2 hours", bucket="1 hour")


def test_latency_quantiles_are_within_the_stated_error(spark):
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.integers(0, 40, 500), (rng.lognormal(6, 2, 4000)).astype(int), [10**9, 0, 31, 32, 63, 64]]).tolist()
    rows = spark.createDataFrame([(T0, T0 + dt.timedelta(milliseconds=int(v))) for v in values], "event_time timestamp_ntz, ingest_time timestamp_ntz")
    halves = rows.randomSplit([0.5, 0.5], 1)
    parts = progress.latency_parts(halves[0]).unionByName(progress.latency_parts(halves[1]))  # two batches, merged by adding
    assert parts.count() < 2 * 1_200
    got = progress.latency(parts, (0.01, 0.5, 0.95, 0.99, 1.0)).first()
    assert got["measured"] == len(values)
    order = sorted(values)
    for q, name in ((0.01, "p1_ms"), (0.5, "p50_ms"), (0.95, "p95_ms"), (0.99, "p99_ms"), (1.0, "p100_ms")):
        exact = order[math.ceil(q * len(order)) - 1]
        assert got[name] <= exact < got[name] * (1 + 1 / progress.LATENCY_STEPS) + 1, name
    none = progress.latency(progress.latency_parts(rows.limit(0))).first()
    assert none["measured"] == 0 and none["p50_ms"] is None


def test_metric_parts_add_up(spark):
    rows = [(T0 + dt.timedelta(minutes=7 * k), k * 1.25, k % 5 == 0) for k in range(200)]
    table = spark.createDataFrame(rows, "event_time timestamp_ntz, amount double, final_is_fraud boolean").withColumn(
        "amount", F.col("amount").cast("decimal(12,2)"))
    shares = [reports.metric_parts(table.where(F.pmod(F.xxhash64("amount"), F.lit(3)) == k)) for k in range(3)]
    merged = reports.metrics_of(reports.merged_metrics(shares[0].unionByName(shares[1]).unionByName(shares[2])))
    assert merged.collect() == reports.fraud_metrics(table).collect()


def test_thresholds_by_validity(spark):
    versions = spark.createDataFrame([("atm", 100.0, T0), ("atm", 300.0, T0 + dt.timedelta(days=2)), ("atm", 200.0, T0 + dt.timedelta(days=2)),
                                      ("gas", 50.0, T0 + dt.timedelta(days=1))], "merchant_category string, threshold double, valid_from timestamp_ntz")
    rows = [("before", "atm", T0 - dt.timedelta(seconds=1)), ("at", "atm", T0), ("last", "atm", T0 + dt.timedelta(days=2, seconds=-1)),
            ("tie", "atm", T0 + dt.timedelta(days=2)), ("gas0", "gas", T0), ("gas1", "gas", T0 + dt.timedelta(days=9)),
            ("other", "zoo", T0), ("none", None, T0), ("notime", "atm", None)]
    txn = spark.createDataFrame(rows, "transaction_id string, merchant_category string, event_time timestamp_ntz")
    want = {"before": 5000.0, "at": 100.0, "last": 100.0, "tie": 300.0, "gas0": 5000.0, "gas1": 50.0, "other": 5000.0, "none": 5000.0,
            "notime": 5000.0}
    got = rules.thresholds_asof(txn, versions)
    assert {r["transaction_id"]: r["threshold"] for r in got.collect()} == want and got.columns == [*txn.columns, "threshold"]
    instants = rules.thresholds_asof(txn.withColumn("event_time", jobs.as_instant("event_time")), versions)
    assert {r["transaction_id"]: r["threshold"] for r in instants.collect()} == want
    assert {r["threshold"] for r in rules.thresholds_asof(txn, versions.limit(0)).collect()} == {5000.0}


def alerts(spark, path, days=4):
    rows = [(f"a{d}{k}", dt.date(2024, 1, 1 + d), False, None, None) for d in range(days) for k in range(3)]
    schema = "transaction_id string, event_date date, reviewed boolean, reviewed_at timestamp_ntz, true_positive boolean"
    spark.createDataFrame(rows, schema).write.partitionBy("event_date").parquet(path)
    return schema


def reviews(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, reviewed boolean, reviewed_at timestamp_ntz, true_positive boolean")


def files(spark, path):
    return {n: sorted(storage.data_files(spark, f"{path}/{n}")) for n in storage.names(spark, path) if "=" in n}


def test_write_back_rewrites_only_touched_partitions(spark, scratch):
    path = os.path.join(scratch, "alerts")
    alerts(spark, path)
    before = files(spark, path)
    r = reviews(spark, [("a10", True, T0, True), ("a10", True, None, False), ("a11", True, None, False), ("none", True, T0, True)])
    assert feedback.write_back(spark, path, r) == 1
    after = files(spark, path)
    assert {n for n in before if before[n] != after[n]} == {"event_date=2024-01-02"}
    got = {x["transaction_id"]: (x["reviewed"], x["reviewed_at"], x["true_positive"]) for x in spark.read.parquet(path).collect()}
    assert len(got) == 12 and got["a10"] == (True, T0, True) and got["a11"] == (True, None, False) and got["a00"] == (False, None, None)
    assert feedback.write_back(spark, path, reviews(spark, [("x", True, T0, True)])) == 0 and files(spark, path) == after
    assert feedback.write_back(spark, os.path.join(scratch, "nowhere"), r) == 0


def test_a_crash_while_writing_back_is_completed(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "alerts")
    alerts(spark, path)
    real, calls = feedback._finish_write_back, []

    def crash(*a):
        calls.append(a)
        if len(calls) == 2:  # rows are ready, the partitions not yet replaced
            raise RuntimeError("lost")
        return real(*a)

    monkeypatch.setattr(feedback, "_finish_write_back", crash)
    with pytest.raises(RuntimeError):
        feedback.write_back(spark, path, reviews(spark, [("a10", True, T0, True), ("a30", True, T0, False)]))
    assert spark.read.parquet(path).where("reviewed").count() == 0
    assert feedback.write_back(spark, path, reviews(spark, [("a00", True, T0, True)])) == 1
    got = spark.read.parquet(path)
    assert got.count() == 12 and {r[0] for r in got.where("reviewed").select("transaction_id").collect()} == {"a00", "a10", "a30"}


def test_equal_review_times_pick_the_same_row(spark):
    a = spark.createDataFrame([("a", False, None, None)], "transaction_id string, reviewed boolean, reviewed_at timestamp_ntz, true_positive boolean")
    both = [("a", True, T0, True), ("a", True, T0, False)]
    assert feedback.apply(a, reviews(spark, both)).collect() == feedback.apply(a, reviews(spark, both[::-1])).collect()
