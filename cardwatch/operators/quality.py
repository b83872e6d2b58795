"""Record validation against the wire record's JSON-Schema constraints.

Each failed check adds a fixed name to ``violations`` (in check order):
``missing:<field>``, ``format:transaction_id``, ``number:amount``,
``minimum:amount``, ``maximum:amount``, ``length:currency``, ``enum:merchant_category``,
``enum:card_type``, ``pattern:card_last4``, ``format:timestamp``.
All checks are built-in expressions; rows are split, never dropped.

A violation is blocking if the row could not be stored or placed in time
(``BLOCKING``); any other is advisory: the record is scored and stored like the
original does (an unknown category gets the default threshold).
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch import schema as S
from cardwatch.sources.codec import parse_event_time

UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
DATETIME_PATTERN = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?"
                    r"([Zz]|[+-][0-9]{2}:?[0-9]{2})?$")


BLOCKING = ("missing:transaction_id", "missing:user_id", "missing:amount", "missing:timestamp",
            "number:amount", "maximum:amount", "format:timestamp")


def checks() -> list[tuple[str, Column]]:
    """(violation name, failing condition) pairs; a NULL field fails only its ``missing`` check."""
    c = F.col
    out = [(f"missing:{f}", c(f).isNull()) for f in S.REQUIRED_FIELDS]
    amount = c("amount")
    out += [
        ("format:transaction_id", ~c("transaction_id").rlike(UUID_PATTERN)),
        ("number:amount", F.isnan(amount) | (F.abs(amount) == F.lit(float("inf")))),
        ("minimum:amount", amount < F.lit(0.0)),
        ("maximum:amount", ~F.isnan(amount) & (amount != F.lit(float("inf"))) & (amount >= F.lit(S.AMOUNT_LIMIT))),
        ("length:currency", F.length(c("currency")) != 3),
        ("enum:merchant_category", ~c("merchant_category").isin(*S.CATEGORY_ENUM)),
        ("enum:card_type", ~c("card_type").isin(*S.CARD_TYPE_ENUM)),
        ("pattern:card_last4", ~c("card_last4").rlike(S.CARD_LAST4_PATTERN)),
        ("format:timestamp", ~c("timestamp").rlike(DATETIME_PATTERN)
         | (c("timestamp").isNotNull() & parse_event_time(c("timestamp")).isNull())),
    ]
    return out


def violations() -> Column:
    """Comma-joined violation names ('' when valid); NULL conditions do not fail."""
    return F.concat_ws(",", *[F.when(cond, F.lit(name)) for name, cond in checks()])


def validate(df: DataFrame, out: str = "violations", only: Column | None = None) -> DataFrame:
    """Adds ``violations`` (string) and ``is_valid``; both NULL where ``only`` is not true, whose rows are then not checked."""
    names = violations() if only is None else F.when(only, violations())
    return df.withColumn(out, names).withColumn("is_valid", F.col(out) == "")


def blocked(violations_col: str = "violations") -> Column:
    """True if any violation of the row is blocking."""
    return F.arrays_overlap(F.split(F.col(violations_col), ","), F.array(*[F.lit(b) for b in BLOCKING]))


def blocking() -> Column:
    """:func:`blocked` of a row not yet validated: only the blocking checks are made, and no text of violations."""
    return reduce(or_, [F.coalesce(cond, F.lit(False)) for name, cond in checks() if name in BLOCKING])


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows).  Both come from one validated plan."""
    v = validate(df)
    return v.where(F.col("is_valid")), v.where(~F.col("is_valid"))


def report(validated: DataFrame, col: str = "violations") -> DataFrame:
    """Count of rows per violation name."""
    names = F.explode(F.split(F.col(col), ","))
    return (validated.where(F.col(col) != "").select(names.alias("violation"))
            .groupBy("violation").agg(F.count(F.lit(1)).alias("row_count")))
