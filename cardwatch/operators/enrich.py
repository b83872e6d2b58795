"""Enrichment: merchant attributes, currency, home country, international flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch import schema as S

def merchant_dimension(spark: SparkSession, rows=None) -> DataFrame:
    rows = list(rows if rows is not None else S.MERCHANTS)
    return literal_table(spark, rows, ["merchant_id", "merchant_name", "merchant_category", "merchant_country"])


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(float(v)) + "D" if isinstance(v, float) else str(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_table(spark: SparkSession, rows, names: list[str]) -> DataFrame:
    """A small table from literal rows, planned JVM-side as a local relation.

    An inline ``VALUES`` list is parsed in one call and becomes a
    ``LocalTableScan``.  (``createDataFrame`` on a Python list would scan a
    Python RDD and start a Python worker for every query that touches it.)
    """
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def merchant(df: DataFrame, merchants: DataFrame | None = None, key: str = "merchant_id") -> DataFrame:
    """Left join merchant name/category/country onto ``df`` by ``key``.

    No hint: Spark knows the size of a literal or stored table and broadcasts
    it only if it is below the session's threshold.
    """
    if merchants is None:
        merchants = merchant_dimension(df.sparkSession)
    drop = [c for c in ("merchant_name", "merchant_category", "merchant_country") if c in df.columns]
    side = merchants.withColumnRenamed("merchant_id", key) if key != "merchant_id" else merchants
    return df.drop(*drop).join(side, key, "left")


def currency_for(country: Column) -> Column:
    """US -> USD, UK -> GBP, otherwise EUR."""
    expr = None
    for c, cur in S.COUNTRY_CURRENCY.items():
        expr = F.when(country == c, F.lit(cur)) if expr is None else expr.when(country == c, F.lit(cur))
    return expr.otherwise(F.lit(S.DEFAULT_CURRENCY))


def currency(df: DataFrame, country: str = "merchant_country", out: str = "currency") -> DataFrame:
    return df.withColumn(out, currency_for(F.col(country)))


def international(df: DataFrame, homes: DataFrame, user: str = "user_id",
                  home: str = "home_country", country: str = "merchant_country",
                  out: str = "is_international") -> DataFrame:
    """is_international = merchant country differs from the user's home country.

    ``homes`` is a per-user dimension that grows with the user base, so it is
    not hinted; AQE broadcasts it when its measured size allows and otherwise
    runs a sort-merge join on ``user``.
    """
    joined = df.drop(out).join(homes.select(user, home), user, "left")
    return joined.withColumn(out, F.col(country) != F.col(home))
