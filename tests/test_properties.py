"""Invariants over the fixture tables (one row per id, flags consistent, counts add up)."""

from pyspark.sql import functions as F

from conftest import SF0001
from cardwatch.operators import velocity, verdict
from cardwatch.plans import catalog, reports
from cardwatch.sources import fixtures

W, SL, TH = catalog.FIXTURE_WINDOW, catalog.FIXTURE_SLIDE, catalog.FIXTURE_THRESHOLD


def test_one_verdict_per_transaction(spark):
    e = catalog.enriched(spark, SF0001)
    n = fixtures.transactions(spark, SF0001).count()
    assert e.count() == n and e.select("transaction_id").distinct().count() == n
    assert e.where((F.col("final_rule") != "CLEAN") != F.col("final_is_fraud")).count() == 0
    assert e.where(F.col("velocity_fraud") & (F.col("final_rule") != "VELOCITY_BURST")).count() == 0


def test_velocity_flag_ignores_input_order(spark):
    t = fixtures.transactions(spark, SF0001)
    a = velocity.flag(t, window=W, slide=SL, threshold=TH).select("transaction_id", "txn_count")
    shuffled = t.repartition(7, F.rand(seed=3))
    b = velocity.flag(shuffled, window=W, slide=SL, threshold=TH).select("transaction_id", "txn_count")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_pane_join_equals_expansion(spark):
    t = fixtures.transactions(spark, SF0001)
    a = velocity.flag(t, window=W, slide=SL, threshold=TH).select("transaction_id", "txn_count")
    b = velocity.flag_by_expansion(t, window=W, slide=SL, threshold=TH).select("transaction_id", "txn_count")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fixture_counts_match_survey(spark):
    """FIXTURES.md: rule counts and velocity counts at sf0.001."""
    e = catalog.enriched(spark, SF0001)
    by_rule = {r["fraud_rule"]: r["count"] for r in e.groupBy("fraud_rule").count().collect()}
    assert by_rule == {"CLEAN": 553, "HIGH_AMOUNT": 350, "INTL_ATM_WITHDRAWAL": 5, "UNUSUAL_HOUR": 92}
    assert e.where("velocity_fraud").count() == 55
    t = fixtures.transactions(spark, SF0001)
    assert velocity.join_windows(t, window=W, slide=SL, threshold=TH, how="inner").count() == 138
    assert velocity.trailing(t, W, TH).where("trailing_fraud").count() == 29


def test_histogram_counts_sum_to_input(spark):
    t = catalog.txn_table(spark, SF0001)
    h = reports.amount_histogram(t)
    assert h.agg(F.sum("txn_count")).first()[0] == t.where(F.col("amount") < 2000).count()
    assert h.agg(F.max("bin")).first()[0] <= 59


def test_alerts_are_the_fraud_subset(spark):
    e = catalog.enriched(spark, SF0001)
    assert verdict.alerts(e).count() == e.where("final_is_fraud").count()


def _same(a, b):
    a = a.select("transaction_id", "trailing_count")
    b = b.select("transaction_id", "trailing_count")
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_trailing_split_equals_trailing(spark):
    t = fixtures.transactions(spark, SF0001)
    assert _same(velocity.trailing(t, W, TH), velocity.trailing_split(t, W, TH))
    assert _same(velocity.trailing(t, W, TH), velocity.trailing_split(t, W, TH, bucket="7 hours"))
    assert _same(velocity.trailing(t, W, TH, lower_inclusive=False),
                 velocity.trailing_split(t, W, TH, lower_inclusive=False, bucket="5 hours"))


def test_trailing_split_hot_user_with_ties_and_gaps(spark):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    secs = [0, 0, 0, 5, 30, 59, 60, 60, 61, 119, 120, 400, 401, 401, 460, 461, 3600, 3659, 3660, 3660]
    rows = [(f"h{i}", "HOT", base + dt.timedelta(seconds=s)) for i, s in enumerate(secs)]
    rows += [(f"c{i}", "COLD", base + dt.timedelta(seconds=s)) for i, s in enumerate([0, 61, 62])]
    df = spark.createDataFrame(rows, "transaction_id string, user_id string, event_time timestamp_ntz")
    for inclusive in (True, False):
        ref = velocity.trailing(df, "60 seconds", 3, lower_inclusive=inclusive)
        for b in (None, "1 second", "7 seconds", "59 seconds"):
            got = velocity.trailing_split(df, "60 seconds", 3, lower_inclusive=inclusive, bucket=b)
            assert _same(ref, got), (inclusive, b)
    import pytest
    with pytest.raises(ValueError):
        velocity.trailing_split(df, "60 seconds", 3, bucket="2 minutes")


def test_velocity_matches_brute_force(spark):
    import datetime as dt

    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    base = dt.datetime(2024, 1, 1)
    W, SL, TH_ = 60, 10, 2
    ev = st.tuples(st.sampled_from(["U1", "U2", "U3"]), st.integers(0, 400))

    @settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(ev, min_size=5, max_size=120))
    def check(events):
        rows = [(f"t{i}", u, base + dt.timedelta(seconds=s)) for i, (u, s) in enumerate(events)]
        df = spark.createDataFrame(rows, "transaction_id string, user_id string, event_time timestamp_ntz")
        flag = {r["transaction_id"]: r["txn_count"] for r in
                velocity.flag(df, window="60 seconds", slide="10 seconds", threshold=TH_).collect()}
        trail = {r["transaction_id"]: r["trailing_count"] for r in
                 velocity.trailing_split(df, "60 seconds", TH_, bucket="15 seconds").collect()}
        for tid, u, s in [(f"t{i}", u, s) for i, (u, s) in enumerate(events)]:
            mine = [x for (v, x) in events if v == u]
            counts = []
            for start in range((s // SL) * SL - W + SL, s + 1, SL):   # windows [start, start + W) holding s
                c = sum(1 for x in mine if start <= x < start + W)
                if c > TH_:
                    counts.append(c)
            assert flag[tid] == (max(counts) if counts else None), (tid, u, s)
            assert trail[tid] == sum(1 for x in mine if s - W <= x <= s), (tid, u, s)

    check()


def test_long_user_numbers_stay_distinct(spark, tmp_path):
    """User numbers above 99,999 keep all digits, so the user table joins one to one."""
    import datetime as dt

    rows = [(k, dt.datetime(2024, 1, 1, 0, 0, k % 60), u, "view", 10.0) for k, u in enumerate([123456, 123457, 12345, 7] * 3)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, kind string, value double").write.parquet(
        str(tmp_path / "events.parquet"))
    t = catalog.q_enrich_international(spark, str(tmp_path))
    assert t.count() == 12 and t.select("user_id").distinct().count() == 4
    assert {r["user_id"] for r in t.collect()} == {"USR_123456", "USR_123457", "USR_12345", "USR_00007"}


def test_trailing_counts_take_linear_time(spark):
    """One user's events of one day: twice the rows take about twice the time."""
    import time

    def run(n):
        df = spark.range(n).select(F.concat(F.lit("t"), "id").alias("transaction_id"), F.lit("u").alias("user_id"),
                                   F.timestamp_add("MICROSECOND", F.col("id") * (86_000_000_000 // n),
                                                   F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")).alias("event_time"))
        t0 = time.perf_counter()
        got = velocity.trailing(df, "24 hours", 6).agg(F.max("trailing_count"), F.sum("trailing_count")).first()
        assert got[0] == n and got[1] == n * (n + 1) // 2
        return time.perf_counter() - t0

    run(1000)
    a, b = run(20_000), run(40_000)
    assert b < 2 * a + 2


def test_windows_count_panes_not_events(spark):
    t = fixtures.transactions(spark, SF0001)
    plan = velocity.windows(t, W, SL, TH)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_tables_have_the_stated_columns(spark):
    from cardwatch import schema as S

    assert catalog.txn_table(spark, SF0001).columns == S.TRANSACTIONS_TABLE_COLUMNS
    assert catalog.alerts_table(spark, SF0001).columns == S.ALERTS_TABLE_COLUMNS
