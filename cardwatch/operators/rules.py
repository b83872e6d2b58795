"""Per-row risk rules as native column expressions.

A rule is a function returning a nullable ``struct<is_fraud, rule_name,
confidence, reason>`` column: the struct when the rule fires, NULL otherwise.
A :class:`RuleSet` is an ordered list of rules; the first firing rule wins
(``coalesce``), or all firing rules are kept (``filter(array(...))``).  No
Python UDF is involved, so the whole rule layer stays inside whole-stage
codegen and is visible to Catalyst.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch import schema as S
from cardwatch.functions import hour_as_written, round_half_up, to_utc_ntz

RuleFn = Callable[[], Column]

_COLUMN_CACHE: dict = {}


def _reusable(fn):
    """Reuse the Column a rule builder returns for the same (hashable) arguments.

    A Column is an unresolved expression, independent of any DataFrame or
    data, so building it once saves hundreds of JVM round trips per query
    plan.  Calls with unhashable arguments (a Column, a dict) build afresh.
    """
    import functools

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        try:
            key = (fn.__qualname__, args, tuple(sorted(kwargs.items())))
            hash(key)
        except TypeError:
            return fn(*args, **kwargs)
        col = _COLUMN_CACHE.get(key)
        if col is None:
            col = _COLUMN_CACHE[key] = fn(*args, **kwargs)
        return col

    return wrapper


def signal(rule_name, confidence, reason, is_fraud=True) -> Column:
    """Build a verdict struct from columns or literals."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(
        lit(is_fraud).cast("boolean").alias("is_fraud"),
        lit(rule_name).cast("string").alias("rule_name"),
        lit(confidence).cast("double").alias("confidence"),
        lit(reason).cast("string").alias("reason"),
    )


@_reusable
def clean_signal() -> Column:
    return signal(S.RULE_CLEAN, 0.0, S.REASON_CLEAN, is_fraud=False)


def when_rule(predicate: Column, sig: Column) -> Column:
    """NULL unless ``predicate`` is true (NULL predicates do not fire)."""
    return F.when(predicate, sig)


# ---------------------------------------------------------------- R1
@_reusable
def category_threshold(category="merchant_category", thresholds: dict | None = None,
                       default: float = S.DEFAULT_THRESHOLD) -> Column:
    """Threshold per category as a CASE over the (small, fixed) threshold table."""
    cat = F.col(category) if isinstance(category, str) else category
    expr = None
    for name, value in (thresholds or S.CATEGORY_THRESHOLDS).items():
        expr = (F.when(cat == name, F.lit(float(value))) if expr is None
                else expr.when(cat == name, F.lit(float(value))))
    return expr.otherwise(F.lit(float(default))) if expr is not None else F.lit(float(default))


@_reusable
def high_amount(amount="amount", category="merchant_category", thresholds: dict | None = None,
                default: float = S.DEFAULT_THRESHOLD, threshold: str | None = None) -> Column:
    """amount > threshold(category); confidence min(1, (amount/t - 1)*0.5 + 0.6) to 3 dp.

    ``threshold`` names a column with each row's own threshold (:func:`thresholds_asof`) instead.
    """
    a = F.col(amount)
    t = F.col(threshold) if threshold else category_threshold(category, thresholds, default)
    conf = round_half_up(F.least(F.lit(1.0), (a / t - F.lit(1.0)) * F.lit(0.5) + F.lit(0.6)), 3)
    reason = F.format_string(S.REASON_HIGH_AMOUNT, a, F.coalesce(F.col(category), F.lit("None")), t)
    return when_rule(a > t, signal(S.RULE_HIGH_AMOUNT, conf, reason))


def thresholds_asof(txn: DataFrame, versions: DataFrame, time: str = "event_time", category: str = "merchant_category",
                    default: float = S.DEFAULT_THRESHOLD, out: str = "threshold") -> DataFrame:
    """``txn`` with the threshold that was in force at each row's time (batch or stream to static table).

    ``versions`` holds (merchant_category, threshold, valid_from): a version is
    in force from ``valid_from`` on until the category's next one.  Before the
    first version, and for an unknown or NULL category, the default applies; of
    versions with one ``valid_from`` the highest threshold does.  The versions
    of a category become one sorted array, so the join is on the category alone
    and a row is neither copied nor matched with several versions; Spark
    broadcasts the few categories if they are below its threshold.
    """
    entry = F.struct(F.col("valid_from").alias("since"), F.col("threshold").cast("double").alias("threshold"))
    history = (versions.groupBy(F.col("merchant_category").alias("_category"))
               .agg(F.array_sort(F.collect_set(entry)).alias("_history")))
    joined = txn.join(history, F.col(category) == F.col("_category"), "left")
    when = F.col(time) if dict(txn.dtypes)[time] == "timestamp_ntz" else to_utc_ntz(F.col(time))
    past = F.filter("_history", lambda v: v["since"] <= when)
    return joined.withColumn(out, F.coalesce(F.try_element_at(past, F.lit(-1))["threshold"], F.lit(float(default)))).drop("_category", "_history")


# ---------------------------------------------------------------- R2
@_reusable
def international_atm(category="merchant_category", international="is_international", amount="amount",
                      min_amount: float = S.INTL_ATM_MIN_AMOUNT) -> Column:
    """ATM + international (NULL counts as false) + amount > 200."""
    a = F.col(amount)
    pred = (F.col(category) == "atm") & F.coalesce(F.col(international), F.lit(False)) & (a > F.lit(min_amount))
    return when_rule(pred, signal(S.RULE_INTL_ATM, S.INTL_ATM_CONFIDENCE,
                                  F.format_string(S.REASON_INTL_ATM, a)))


# ---------------------------------------------------------------- R3
@_reusable
def odd_hours(timestamp="timestamp", amount="amount", hours=S.UNUSUAL_HOURS,
              min_amount: float = S.UNUSUAL_HOUR_MIN_AMOUNT) -> Column:
    """Hour as written in 1..4 and amount > 200."""
    a = F.col(amount)
    h = hour_as_written(F.col(timestamp))
    pred = h.between(hours[0], hours[1]) & (a > F.lit(min_amount))
    return when_rule(pred, signal(S.RULE_UNUSUAL_HOUR, S.UNUSUAL_HOUR_CONFIDENCE,
                                  F.format_string(S.REASON_UNUSUAL_HOUR, a, h)))


# ---------------------------------------------------------------- labels (simulator patterns)
@_reusable
def extreme_amount(amount="amount", limit: float = S.EXTREME_AMOUNT) -> Column:
    return when_rule(F.col(amount) > F.lit(limit), signal("EXTREME_AMOUNT", 1.0, "extreme amount"))


@_reusable
def geo_anomaly(home_country="home_country", merchant_country="merchant_country", amount="amount",
                home: str = S.GEO_HOME_COUNTRY, min_amount: float = S.GEO_MIN_AMOUNT) -> Column:
    pred = (F.col(home_country) == home) & (F.col(merchant_country) != home) & (F.col(amount) > F.lit(min_amount))
    return when_rule(pred, signal("GEO_ANOMALY", 1.0, "merchant outside home country"))


@_reusable
def off_hours_atm(event_time="event_time", category="merchant_category", amount="amount",
                  hours=S.OFF_HOURS, min_amount: float = S.OFF_HOURS_MIN_AMOUNT) -> Column:
    pred = (F.hour(F.col(event_time)).between(hours[0], hours[1]) & (F.col(category) == "atm")
            & (F.col(amount) > F.lit(min_amount)))
    return when_rule(pred, signal("OFF_HOURS_ATM", 1.0, "ATM use off hours"))


@_reusable
def rapid_use(flag="rapid_use") -> Column:
    """Fires on a precomputed velocity flag (see ``velocity.trailing``)."""
    return when_rule(F.coalesce(F.col(flag), F.lit(False)), signal("RAPID_USE", 1.0, "rapid use"))


# ---------------------------------------------------------------- sets
@dataclass
class RuleSet:
    """Ordered rules; list order is priority.  Add a rule by appending a function."""

    rules: list[tuple[str, RuleFn]] = field(default_factory=list)

    def add(self, name: str, fn: RuleFn) -> "RuleSet":
        self.rules.append((name, fn))
        return self

    def columns(self) -> list[Column]:
        return [fn() for _, fn in self.rules]

    def first_match(self) -> Column:
        """First firing rule, else the CLEAN signal."""
        return F.coalesce(*self.columns(), clean_signal())

    def all_matches(self) -> Column:
        """Array of every firing rule's signal, in priority order."""
        return F.filter(F.array(*self.columns()), lambda s: s.isNotNull())

    def apply(self, df: DataFrame, prefix: str = "") -> DataFrame:
        """Add stateless_fraud, fraud_rule, fraud_confidence, fraud_reason."""
        sig = self.first_match()
        return (df.withColumn("_sig", sig)
                .withColumn(prefix + "stateless_fraud", F.col("_sig.is_fraud"))
                .withColumn(prefix + "fraud_rule", F.col("_sig.rule_name"))
                .withColumn(prefix + "fraud_confidence", F.col("_sig.confidence"))
                .withColumn(prefix + "fraud_reason", F.col("_sig.reason"))
                .drop("_sig"))


def stateless_rules() -> RuleSet:
    """The three stateless rules in the original priority order."""
    return RuleSet([("HIGH_AMOUNT", high_amount), ("INTL_ATM_WITHDRAWAL", international_atm),
                    ("UNUSUAL_HOUR", odd_hours)])


def label_rules() -> RuleSet:
    """Simulator label patterns in their priority order (extreme, rapid, geo, off-hours)."""
    return RuleSet([("EXTREME_AMOUNT", extreme_amount), ("RAPID_USE", rapid_use),
                    ("GEO_ANOMALY", geo_anomaly), ("OFF_HOURS_ATM", off_hours_atm)])


def apply_rules(df: DataFrame, rules: RuleSet | None = None) -> DataFrame:
    return (rules or stateless_rules()).apply(df)


def signal_names(col: Column) -> Column:
    """array<struct> of signals -> comma-joined rule names."""
    return F.array_join(F.transform(col, lambda s: s["rule_name"]), ",")


def pandas_rule(fn, input_cols: Sequence[str], name: str, confidence: float, reason: str) -> RuleFn:
    """Wrap a vectorised user predicate (pandas Series... -> bool Series) as a rule.

    Only for rules that built-in expressions cannot state; it runs as an
    Arrow-batched pandas UDF, never per row.
    """
    import pandas as pd

    names = list(input_cols)

    def _pred(batch):
        return fn(*[batch[c] for c in names]).fillna(False).astype(bool)

    # Real types (this module defers annotations), so Spark picks the Series-to-Series form.
    _pred.__annotations__ = {"batch": pd.DataFrame, "return": pd.Series}
    pred = F.pandas_udf(_pred, "boolean")
    return lambda: when_rule(pred(F.struct(*[F.col(c) for c in names])), signal(name, confidence, reason))
