"""Key filters beside files, commits, and merges inside a database."""

import os

import pytest
from pyspark.sql import functions as F

from cardwatch.sources import commits, keyindex, sinks, storage
from cardwatch.sources.tables import read_jdbc

PROPS = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def batch(spark, numbers, day="2024-01-01"):
    rows = spark.createDataFrame([(n,) for n in numbers], "n long")
    # ids in no order that helps a range
    return rows.select(F.md5(F.col("n").cast("string")).alias("transaction_id"), "n", F.lit(day).cast("date").alias("event_date"))


def insert(rows, path):
    return sinks.insert_if_absent(rows, path, partition_by=["event_date"], key_index=True)


def stored(spark, path):
    return sorted(r["n"] for r in spark.read.parquet(path).collect())


def test_a_batch_reads_only_files_that_may_hold_its_keys(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "t")
    for k in range(12):
        assert insert(batch(spark, range(100 * k, 100 * k + 100), f"2024-01-{k + 1:02d}").coalesce(1), path) == 100
    every = keyindex.listed(spark, path, ["event_date"])
    assert len(every) >= 12
    read = []
    real = keyindex.candidates
    monkeypatch.setattr(keyindex, "candidates", lambda *a: read.append(real(*a)) or read[-1])
    assert insert(batch(spark, range(5000, 5040), "2024-01-03"), path) == 40
    assert len(read[-1]) <= 1  # new keys: no file, but for a false match
    # keys of two days sent again with another date, and one new key
    assert insert(batch(spark, [5, 205, 9000], "2024-02-01"), path) == 1
    may = {f.split("event_date=")[1][:10] for f in read[-1]}
    assert {"2024-01-01", "2024-01-03"} <= may and len(may) <= 3
    rows = spark.read.parquet(*read[-1]).count()
    assert rows <= 4 * 100  # of 1,200
    assert stored(spark, path) == sorted([*range(1200), *range(5000, 5040), 9000])


def test_filters_hold_all_keys_and_few_others(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), F.when(F.col("id") < 19_990, "big").otherwise("small").alias("file"))
    index = keyindex.filters(keys, "key", "file").persist()
    assert {r["file"]: r["power"] for r in index.select("file", "power").distinct().collect()} == {"big": 12, "small": 1}
    path = os.path.join(os.environ.get("TMPDIR", "/tmp"), f"cardwatch-keys-{os.getpid()}-{id(index)}")
    index.write.parquet(f"{path}/{keyindex.FOLDER}")
    probe = lambda a, b: keyindex.candidates(spark, path, spark.range(a, b).select(F.concat(F.lit("k"), "id").alias("key")), "key")
    assert probe(0, 1) == ["big"] and sorted(probe(19_989, 19_991)) == ["big", "small"]
    assert all("big" in probe(k, k + 1) for k in (777, 12_345))
    assert sum(len(probe(k, k + 1)) for k in range(30_000, 30_010)) <= 1
    assert keyindex.candidates(spark, path, spark.createDataFrame([(None,)], "key string"), "key") == []


def test_keys_are_not_broadcast(spark):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    keys = spark.range(50).select(F.md5(F.col("id").cast("string")).alias("key"), F.lit("f").alias("file"))
    index = keyindex.filters(keys, "key", "file")
    found = keyindex.hits(index, keys.limit(1), "key")
    assert "SortMergeJoin" in plan(found) and {r["file"] for r in found.collect()} == {"f"}
    fresh = sinks.new_rows(keys, keys.where(F.col("key") < "8"), "key")
    assert "SortMergeJoin" in plan(fresh) and "BroadcastHashJoin" not in plan(fresh)
    assert fresh.count() == keys.where(F.col("key") >= "8").count()


def test_distinct_keys_are_not_grouped_again(spark):
    keys = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "key string, n long")
    old = keys.where("key = 'b'")
    fresh = sinks.new_rows(keys, old, "key", distinct_keys=True)
    assert "Aggregate" not in fresh._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, fresh.collect())) == sorted(map(repr, sinks.new_rows(keys, old, "key").collect())) and fresh.count() == 3


def test_files_without_filters_are_found_after_a_crash(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "t")
    insert(batch(spark, range(10)), path)
    real = keyindex.add
    monkeypatch.setattr(keyindex, "add", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        insert(batch(spark, range(10, 20), "2024-01-02"), path)
    monkeypatch.setattr(keyindex, "add", real)
    assert insert(batch(spark, range(5, 25), "2024-01-03"), path) == 5
    assert stored(spark, path) == list(range(25)) and not storage.names(spark, f"{path}/{keyindex.PENDING}")


def test_an_unindexed_table_is_indexed_first(spark, scratch):
    path = os.path.join(scratch, "t")
    sinks.insert_if_absent(batch(spark, range(10)), path, partition_by=["event_date"])
    nulls = batch(spark, [1, 2]).withColumn("transaction_id", F.lit(None).cast("string"))
    assert insert(batch(spark, [9, 10]).unionByName(nulls), path) == 3
    assert sinks.insert_if_absent(batch(spark, [0, 10, 11]).drop("event_date"), os.path.join(scratch, "flat"), key_index=True) == 3
    assert sinks.insert_if_absent(batch(spark, [0, 12]).drop("event_date"), os.path.join(scratch, "flat"), key_index=True) == 1


def test_commits_are_visible_batch_by_batch(spark, scratch):
    log = commits.Commits(spark, os.path.join(scratch, "c"))
    assert log.totals(["events"]).count() == 0
    table = commits.marked(spark.range(2), "q1", 0).unionByName(commits.marked(spark.range(10, 13), "q1", 1)).unionByName(
        commits.marked(spark.range(20, 21), "q2", 0)).unionByName(spark.createDataFrame([(99, None, None)], "id long, _query string, _batch long"))
    seen = lambda: sorted(r["id"] for r in log.visible(table).collect())
    assert seen() == [99] and log.begin("q1", 0) == "new" and log.begin("q1", 0) == "again"
    log.commit("q1", 0, {"events": 2})
    assert seen() == [0, 1, 99] and log.begin("q1", 0) == "done" and log.begin("q1", 1) == "new"
    log.commit("q1", 1, {"events": 3})
    assert seen() == [0, 1, 10, 11, 12, 99] and log.visible(table).columns == ["id"]
    assert [tuple(r) for r in log.totals(["events"]).collect()] == [(1, 5, "q1")] and log.streams() == ["q1"]
    assert len(storage.names(spark, os.path.join(scratch, "c", "_query=q1"))) <= 2  # the marker and its checksum at most


@pytest.fixture()
def derby(spark, scratch):
    url = f"jdbc:derby:memory:{os.path.basename(scratch).replace('-', '_')};create=true"
    try:
        sinks._connect(spark, url, PROPS).close()
    except Exception as e:  # driver not on the classpath
        pytest.skip(f"derby unavailable: {type(e).__name__}")
    return url


def test_a_merge_that_fails_leaves_both_tables_as_they_were(spark, derby):
    t = spark.createDataFrame([("t1", 1.0), ("t2", 2.0), ("t2", 2.0)], "transaction_id string, amount double")
    a = spark.createDataFrame([("t2", "r")], "transaction_id string, final_rule string")
    assert sinks.jdbc_merge([(t, "txn"), (a, "alerts")], derby, PROPS) == [2, 1]
    more = t.unionByName(spark.createDataFrame([("t3", 3.0)], t.schema))
    alerts = a.unionByName(spark.createDataFrame([("t3", "s")], a.schema))

    def crash():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        sinks.jdbc_merge([(more, "txn"), (alerts, "alerts")], derby, PROPS, before_merge=crash)
    read = lambda name: sorted(r["transaction_id"] for r in read_jdbc(spark, derby, name, PROPS).collect())
    assert read("txn") == ["t1", "t2"] and read("alerts") == ["t2"]
    # a failure between the two tables' inserts: the second one has a column that its target lacks
    with pytest.raises(Exception):
        sinks.jdbc_merge([(more, "txn"), (alerts.withColumn("odd", F.lit(1)), "alerts")], derby, PROPS)
    assert read("txn") == ["t1", "t2"] and read("alerts") == ["t2"]
    assert sinks.jdbc_merge([(more, "txn"), (alerts, "alerts")], derby, PROPS) == [1, 1]  # the replay
    assert read("txn") == ["t1", "t2", "t3"] and read("alerts") == ["t2", "t3"]


def test_a_merge_reads_no_key_in_spark(spark, derby):
    rows = spark.createDataFrame([(f"t{k}", float(k)) for k in range(50)], "transaction_id string, amount double")
    sinks.jdbc_merge([(rows, "big")], derby, PROPS)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    assert sinks.jdbc_merge([(rows.limit(1), "big")], derby, PROPS) == [0]
    assert len(tracker.getJobIdsForGroup(None)) - before <= 3  # the batch's own write


def test_equal_names_in_other_schemas_do_not_count(spark, derby):
    rows = spark.createDataFrame([("t1", 1.0)], "transaction_id string, amount double")
    con = sinks._connect(spark, derby, PROPS)
    sinks._execute(con, "CREATE SCHEMA elsewhere")
    sinks._execute(con, "CREATE TABLE elsewhere.mine (transaction_id INT)")
    assert sinks._has_table(con, "elsewhere.mine") and not sinks._has_table(con, "mine")
    con.close()
    assert sinks.jdbc_append(rows, derby, "mine", PROPS) == 1 and sinks.jdbc_append(rows, derby, "mine", PROPS) == 0


def test_a_null_key_is_an_error(spark, derby):
    rows = spark.createDataFrame([(None, 1.0)], "transaction_id string, amount double")
    with pytest.raises(Exception, match="transaction_id is NULL"):
        sinks.jdbc_append(rows, derby, "nulls", PROPS)


def test_kept_rows_of_a_batch_are_written_in_one_pass(spark, scratch):
    path = os.path.join(scratch, "b")
    rows = batch(spark, range(7))
    assert [sinks.write_batch(rows, path, "q", 1, kept=True) for _ in range(2)] == [7, 7] and sinks.write_batch(rows.limit(0), path, "q", 2, kept=True) == 0
    assert stored(spark, path) == list(range(7)) and storage.names(spark, f"{path}/{commits.QUERY}=q") == [f"{commits.BATCH}=1"]
    assert not rows.is_cached
