"""Transactions derived from the driver's ``events`` table.

The testdata has no card transactions, so every registered query reads
``events`` and turns each event into one transaction by fixed arithmetic on
its ids (a pure projection plus a broadcast join to the 13-row literal
merchant table).  The same derivation is written in SQL in
``cardwatch.plans.oracle`` so DuckDB can repeat it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch import schema as S
from cardwatch.operators import enrich, rules
from cardwatch.sources.tables import read_table

FIXTURE_MERCHANTS = S.MERCHANTS + [S.FIXTURE_EXTRA_MERCHANT]


def home_country_of(user_num: Column) -> Column:
    """Fixture rule for a user's home country (4 in 5 users are US-based)."""
    return (F.when(user_num % 5 < 4, F.lit("US")).when(user_num % 3 == 0, F.lit("US"))
            .when(user_num % 3 == 1, F.lit("UK")).otherwise(F.lit("CA")))


def padded(num: Column, width: int) -> Column:
    """Decimal text with leading zeros up to ``width``; longer numbers keep all digits, so keys stay unique."""
    text = num.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def user_key(user_num: Column) -> Column:
    return F.concat(F.lit("USR_"), padded(user_num, 5))


def transaction_key(event_id: Column) -> Column:
    """UUID-shaped id from the event id (version-4 layout, zero-padded)."""
    return F.concat(F.lit("00000000-0000-4000-8000-"), padded(event_id, 12))


def transactions(spark: SparkSession, sf_dir: str, keep_event_id: bool = False) -> DataFrame:
    """one transaction per event, 17 wire fields plus ``event_time`` (TIMESTAMP_NTZ)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    merchants = enrich.merchant_dimension(spark, FIXTURE_MERCHANTS)
    e, u = F.col("event_id"), F.col("user_id")
    base = ev.select(
        e.alias("event_id"), u.alias("user_num"), F.col("ts").alias("event_time"),
        F.concat(F.lit("MCH_"), F.lpad((e % 13 + 1).cast("string"), 3, "0")).alias("merchant_id"),
        (F.floor(F.col("value") * F.lit(2000.0) + F.lit(0.5)) / F.lit(100.0)).alias("amount"),
    )
    df = enrich.merchant(base, merchants)
    cat, country = F.col("merchant_category"), F.col("merchant_country")
    home = home_country_of(F.col("user_num"))
    df = df.select(
        transaction_key(e).alias("transaction_id"),
        user_key(F.col("user_num")).alias("user_id"),
        F.col("amount"),
        enrich.currency_for(country).alias("currency"),
        "merchant_id", "merchant_name", "merchant_category", "merchant_country",
        F.when(F.col("user_num") % 3 == 2, F.lit("debit")).otherwise(F.lit("credit")).alias("card_type"),
        ((F.col("user_num") * 7919) % 9000 + 1000).cast("string").alias("card_last4"),
        F.concat(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("timestamp"),
        F.when(e % 20 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("device-"), (F.col("user_num") * 2 + e % 2).cast("string")))
         .alias("device_id"),
        F.when(cat == "online", F.concat(F.lit("192.0.2."), (e % 254 + 1).cast("string"))).alias("ip_address"),
        ((e * 37) % 1000 / F.lit(1000.0) * F.lit(120.0) - F.lit(60.0)).alias("latitude"),
        ((e * 53) % 1000 / F.lit(1000.0) * F.lit(360.0) - F.lit(180.0)).alias("longitude"),
        (country != home).alias("is_international"),
        home.alias("home_country"),
        "event_time", "event_id",
    )
    truth = F.coalesce(rules.extreme_amount(), rules.geo_anomaly(), rules.off_hours_atm()).isNotNull()
    df = df.withColumn("is_fraud", truth)
    cols = S.TRANSACTION_FIELDS + ["event_time"] + (["event_id"] if keep_event_id else [])
    return df.select(*cols)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user home-country dimension derived from the users seen in ``events``."""
    ev = read_table(spark, sf_dir, "events").select("user_id").distinct()
    return ev.select(user_key(F.col("user_id")).alias("user_id"),
                     home_country_of(F.col("user_id")).alias("home_country"))


def event_number(transaction_id: Column) -> Column:
    """Inverse of :func:`transaction_key` (all characters after the fixed part, as a number)."""
    return F.substring(transaction_id, F.lit(25), F.length(transaction_id)).cast("bigint")


def reviews(alerts: DataFrame) -> DataFrame:
    """Analyst reviews derived from alerts: every third alert reviewed, 3 of 4 confirmed."""
    n = event_number(F.col("transaction_id"))
    return (alerts.where(n % 3 == 0)
            .select("transaction_id",
                    F.lit(True).alias("reviewed"),
                    F.timestamp_add("HOUR", F.lit(1), F.col("alert_time")).alias("reviewed_at"),
                    (n % 4 != 0).alias("true_positive")))
