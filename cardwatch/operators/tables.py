"""Typed warehouse tables: casts, NOT NULL defaults, creation time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch import schema as S


def _created(created_at) -> Column:
    if created_at is None:
        return F.current_timestamp()
    return created_at if isinstance(created_at, Column) else F.lit(created_at)


def to_transactions_table(enriched: DataFrame, created_at=None) -> DataFrame:
    """The ``transactions`` table: decimals, defaults ('USD', FALSE), ``created_at``."""
    return enriched.select(
        "transaction_id", "user_id",
        F.col("amount").try_cast(S.AMOUNT_TYPE).alias("amount"),
        F.coalesce(F.col("currency"), F.lit("USD")).alias("currency"),
        "merchant_id", "merchant_name", "merchant_category", "merchant_country",
        "card_type", "card_last4", "event_time",
        F.coalesce(F.col("is_international"), F.lit(False)).alias("is_international"),
        F.coalesce(F.col("final_is_fraud"), F.lit(False)).alias("final_is_fraud"),
        "final_rule",
        F.col("fraud_confidence").cast(S.CONFIDENCE_TYPE).alias("fraud_confidence"),
        _created(created_at).alias("created_at"),
    )


def to_alerts_table(alerts: DataFrame, created_at=None) -> DataFrame:
    """The ``fraud_alerts`` table with unreviewed review columns."""
    return alerts.select(
        "transaction_id", "user_id",
        F.col("amount").try_cast(S.AMOUNT_TYPE).alias("amount"),
        "merchant_category", "merchant_country", "final_rule",
        F.col("fraud_confidence").cast(S.CONFIDENCE_TYPE).alias("fraud_confidence"),
        "fraud_reason", "alert_time",
        F.lit(False).alias("reviewed"),
        F.lit(None).cast("timestamp_ntz").alias("reviewed_at"),
        F.lit(None).cast("boolean").alias("true_positive"),
        _created(created_at).alias("created_at"),
    )
