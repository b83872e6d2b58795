"""Rule boundaries and priority (fixture F4)."""

import math

import pytest
from pyspark.sql import functions as F

from cardwatch import schema as S
from cardwatch.operators import rules

COLS = "transaction_id string, amount double, merchant_category string, is_international boolean, timestamp string"


def expected_conf(amount, t):
    return math.floor(min(1.0, (amount / t - 1.0) * 0.5 + 0.6) * 1000 + 0.5) / 1000


def _score(spark, rows):
    df = spark.createDataFrame(rows, COLS)
    return {r["transaction_id"]: r for r in rules.apply_rules(df).collect()}


def test_high_amount_thresholds(spark):
    rows, want = [], {}
    cats = list(S.CATEGORY_THRESHOLDS.items()) + [("casino", S.DEFAULT_THRESHOLD), (None, S.DEFAULT_THRESHOLD)]
    for cat, t in cats:
        for k, a in enumerate([round(t - 0.01, 2), t, round(t + 0.01, 2)]):
            tid = f"{cat}-{k}"
            rows.append((tid, a, cat, False, "2024-01-01T12:00:00+00:00"))
            want[tid] = (a > t, expected_conf(a, t) if a > t else 0.0)
    got = _score(spark, rows)
    for tid, (fires, conf) in want.items():
        r = got[tid]
        assert r["fraud_rule"] == ("HIGH_AMOUNT" if fires else "CLEAN"), tid
        assert r["stateless_fraud"] is fires
        assert r["fraud_confidence"] == pytest.approx(conf, abs=1e-12)
    r = got["atm-2"]
    assert r["fraud_reason"] == "Amount $1500.01 exceeds atm threshold $1500.00"
    assert got["None-2"]["fraud_reason"] == "Amount $5000.01 exceeds None threshold $5000.00"


def test_confidence_capped_at_one(spark):
    got = _score(spark, [("x", 100000.0, "gas", False, "2024-01-01T12:00:00Z")])
    assert got["x"]["fraud_confidence"] == 1.0


@pytest.mark.parametrize("intl,amount,fires", [(True, 200.0, False), (True, 200.01, True),
                                                (False, 900.0, False), (None, 900.0, False)])
def test_international_atm(spark, intl, amount, fires):
    got = _score(spark, [("x", amount, "atm", intl, "2024-01-01T12:00:00+00:00")])["x"]
    assert got["fraud_rule"] == ("INTL_ATM_WITHDRAWAL" if fires else "CLEAN")
    if fires:
        assert got["fraud_confidence"] == pytest.approx(0.80)
        assert got["fraud_reason"] == "International ATM withdrawal of $200.01"


@pytest.mark.parametrize("ts,hour_fires", [
    ("2024-01-01T00:30:00+00:00", False), ("2024-01-01T01:00:00+00:00", True),
    ("2024-01-01T04:59:59+00:00", True), ("2024-01-01T05:00:00+00:00", False),
    ("2024-01-01T02:30:00+05:30", True),   # hour as written, not converted
    ("2024-01-01T03:15:00Z", True), ("2024-01-01T03:15:00", True),
    ("20240101T023000", True),             # compact ISO form
    ("2024-01-01", False),                 # date only: hour 0
])
def test_unusual_hour(spark, ts, hour_fires):
    got = _score(spark, [("a", 250.0, "grocery", False, ts), ("b", 200.0, "grocery", False, ts)])
    assert got["a"]["fraud_rule"] == ("UNUSUAL_HOUR" if hour_fires else "CLEAN")
    assert got["b"]["fraud_rule"] == "CLEAN"   # amount must exceed 200
    if hour_fires:
        assert got["a"]["fraud_confidence"] == pytest.approx(0.65)
        assert got["a"]["fraud_reason"].startswith("$250.00 transaction at 0")


def test_priority_and_all_matches(spark):
    # atm 1600 abroad at 02:00 fires all three; HIGH_AMOUNT wins.
    df = spark.createDataFrame([("x", 1600.0, "atm", True, "2024-01-01T02:00:00Z")], COLS)
    r = rules.apply_rules(df).first()
    assert r["fraud_rule"] == "HIGH_AMOUNT"
    m = df.select(rules.signal_names(rules.stateless_rules().all_matches()).alias("n")).first()["n"]
    assert m == "HIGH_AMOUNT,INTL_ATM_WITHDRAWAL,UNUSUAL_HOUR"
    # 300 atm abroad at 02:00: INTL before UNUSUAL_HOUR
    df2 = spark.createDataFrame([("y", 300.0, "atm", True, "2024-01-01T02:00:00Z")], COLS)
    assert rules.apply_rules(df2).first()["fraud_rule"] == "INTL_ATM_WITHDRAWAL"


def test_rules_stay_native(spark):
    df = spark.createDataFrame([("x", 1.0, "gas", False, "2024-01-01T02:00:00Z")], COLS)
    plan = rules.apply_rules(df)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_custom_rule_appended(spark):
    rs = rules.stateless_rules().add("ROUND_AMOUNT", lambda: rules.when_rule(
        (F.col("amount") % 100) == 0, rules.signal("ROUND_AMOUNT", 0.3, "round amount")))
    df = spark.createDataFrame([("x", 300.0, "gas", False, "2024-01-01T12:00:00Z")], COLS)
    assert rules.apply_rules(df, rs).first()["fraud_rule"] == "ROUND_AMOUNT"


def test_pandas_rule_is_arrow_batched(spark):
    """A user rule that built-ins cannot state runs as a vectorised pandas UDF, never per row."""
    def last_digit_seven(amount):
        return (amount.round().astype("int64") % 10) == 7

    rs = rules.stateless_rules().add("LUCKY", rules.pandas_rule(last_digit_seven, ["amount"], "LUCKY", 0.1, "lucky"))
    df = spark.createDataFrame([("x", 17.0, "gas", False, "2024-01-01T12:00:00Z"),
                                ("y", 18.0, "gas", False, "2024-01-01T12:00:00Z")], COLS)
    out = rules.apply_rules(df, rs)
    assert {r["transaction_id"]: r["fraud_rule"] for r in out.collect()} == {"x": "LUCKY", "y": "CLEAN"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan


def _python_rules(amount, cat, intl, hour):
    """The rule semantics stated directly, as a brute-force oracle."""
    t = S.CATEGORY_THRESHOLDS.get(cat, S.DEFAULT_THRESHOLD)
    if amount > t:
        return "HIGH_AMOUNT", expected_conf(amount, t), "Amount $%.2f exceeds %s threshold $%.2f" % (amount, cat, t)
    if cat == "atm" and intl and amount > 200:
        return "INTL_ATM_WITHDRAWAL", 0.8, "International ATM withdrawal of $%.2f" % amount
    if 1 <= hour <= 4 and amount > 200:
        return "UNUSUAL_HOUR", 0.65, "$%.2f transaction at %02d:xx" % (amount, hour)
    return "CLEAN", 0.0, "No fraud signals detected"


def test_rules_match_brute_force(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    cats = st.sampled_from(list(S.CATEGORY_THRESHOLDS) + ["casino", None])
    row = st.tuples(st.integers(0, 3_000_000), cats, st.sampled_from([True, False, None]), st.integers(0, 23))

    @settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(row, min_size=50, max_size=300))
    def check(rows):
        data = [(f"t{i}", cents / 100.0, cat, intl, "2024-03-05T%02d:17:00+00:00" % hour)
                for i, (cents, cat, intl, hour) in enumerate(rows)]
        got = _score(spark, data)
        for (tid, amount, cat, intl, _), (_, _, _, hour) in zip(data, rows):
            rule, conf, reason = _python_rules(amount, cat, intl, hour)
            r = got[tid]
            assert (r["fraud_rule"], r["fraud_reason"]) == (rule, reason), (amount, cat, intl, hour)
            assert r["fraud_confidence"] == pytest.approx(conf, abs=1e-12)

    check()
