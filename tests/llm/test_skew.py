"""Joins with a hot key: adaptive execution splits it, as its side is a plain shuffle read."""

import contextlib

from pyspark.sql import functions as F

from cardwatch.llm import common, secrets, simhash

SKEW = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16"}


@contextlib.contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_secret_in_a_third_of_the_rows(spark):
    rows = spark.range(0, 6000, 1, 12).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("password = the-same-for-all")).otherwise(F.concat(F.lit("token = own-"), "id", F.lit("-secret"))).alias("text"),
        F.concat(F.lit("owner"), F.col("id") % 7, F.lit("/r"), F.col("id")).alias("source"))
    with settings(spark, SKEW):
        found = secrets.scan(rows)
        got = found.collect()
        assert "skew=true" in plan(found)
    assert len(got) == 6000 and all(len(r["secrets"]) == 1 for r in got)
    assert {(r["doc_id"] % 3 == 0, r["secrets"][0]["live"]) for r in got} == {(True, False), (False, True)}
    assert {r["secrets"][0]["n_owners"] for r in got if r["doc_id"] % 3 == 0} == {7}


def test_one_component_with_a_third_of_the_vertices(spark, monkeypatch):
    """A star: all fingerprints one bit from the middle one, beside many on their own."""
    seen = []
    real = common.shared

    def watched(df):
        out = real(df)
        seen.append(plan(df))
        return out

    monkeypatch.setattr(common, "shared", watched)
    star = spark.range(1, 4001).select((F.col("id") + 10**6).alias("u"), F.lit(1).cast("long").alias("v"))
    lone = spark.range(1, 8001).select((F.col("id") * 2 + 10**8).alias("v"), (F.col("id") * 2 + 1 + 10**8).alias("u")).select("u", "v")
    with settings(spark, SKEW):
        tree = simhash.components(star.union(lone)).collect()
    assert {r["u"]: r["v"] for r in tree} == {**{k + 10**6: 1 for k in range(1, 4001)}, **{2 * k + 1 + 10**8: 2 * k + 10**8 for k in range(1, 8001)}}


def test_component_names_are_joined_split(spark):
    rows = spark.range(0, 3000, 1, 12).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("root"), F.col("id").alias("fp"),
                                              F.rpad(F.lit("x"), 40, "y").alias("pad"))
    with settings(spark, SKEW):
        rooted = common.shared(rows)
        named = common.shared(rooted.groupBy("root").agg(F.min("fp").alias("component_id")))
        joined = rooted.join(named, "root")
        assert joined.count() == 3000
        out = joined.select("fp", "component_id")
        assert len(out.collect()) == 3000 and "skew=true" in plan(out)
