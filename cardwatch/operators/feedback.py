"""Analyst feedback: review queue, applying reviews, precision, confusion counts."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.functions import round_half_up
from cardwatch.sources import storage


def queue(alerts_table: DataFrame) -> DataFrame:
    """Unreviewed alerts, newest first."""
    return alerts_table.where(~F.col("reviewed")).orderBy(F.col("alert_time").desc(), F.col("transaction_id"))


def apply(alerts_table: DataFrame, reviews: DataFrame) -> DataFrame:
    """Overwrite review columns by ``transaction_id`` from a reviews table.

    ``reviews`` holds (transaction_id, reviewed, reviewed_at, true_positive);
    the latest review per id wins; one without a time counts as the earliest,
    and equal times go by the review's hash, so a rerun picks the same.  Both
    sides are keyed on ``transaction_id``
    so the join is a plain shuffle join (AQE may broadcast small review sets).
    """
    order = F.struct(F.col("reviewed_at").isNotNull(), "reviewed_at", F.xxhash64("reviewed", "reviewed_at", "true_positive"))
    latest = (reviews.groupBy("transaction_id")
              .agg(F.max_by(F.struct("reviewed", "reviewed_at", "true_positive"), order).alias("r")))
    latest = latest.select("transaction_id", F.col("r.reviewed").alias("_reviewed"),
                           F.col("r.reviewed_at").alias("_reviewed_at"), F.col("r.true_positive").alias("_tp"))
    j = alerts_table.join(latest, "transaction_id", "left")
    return (j.withColumn("reviewed", F.coalesce(F.col("_reviewed"), F.col("reviewed")))
            .withColumn("reviewed_at", F.coalesce(F.col("_reviewed_at"), F.col("reviewed_at")))
            .withColumn("true_positive", F.coalesce(F.col("_tp"), F.col("true_positive")))
            .drop("_reviewed", "_reviewed_at", "_tp").select(*alerts_table.columns))


def write_back(spark, path: str, reviews: DataFrame, partition_by: str = "event_date") -> int:
    """Set the review columns in the stored alerts table, rewriting only the partitions that hold a reviewed alert; returns how many.

    The ids' partitions are found by a join that reads the id column only.  Their
    rows, reviews applied, are first written beside the table and noted as
    ready, and then replace the partitions (dynamic partition overwrite); files
    of other partitions are not touched.  After a crash the next call starts with
    the noted rows, so a partition is never lost or half written for good.
    """
    work = f"{path}/_review"
    _finish_write_back(spark, path, work, partition_by)
    if not storage.exists(spark, path):
        return 0
    table = spark.read.parquet(path)
    ids = reviews.select("transaction_id").distinct()
    days = table.select("transaction_id", partition_by).join(ids, "transaction_id", "left_semi").select(partition_by).distinct()
    touched = [r[0] for r in days.collect()]  # partitions, not rows
    if not touched:
        return 0
    known = [d for d in touched if d is not None]
    here = F.col(partition_by).isin(known) if known else F.lit(False)
    if len(known) < len(touched):
        here = here | F.col(partition_by).isNull()
    number = uuid.uuid4().hex
    apply(table.where(here), reviews).write.partitionBy(partition_by).parquet(f"{work}/rows-{number}")
    storage.write_json(spark, f"{work}/ready.json", {"rows": f"rows-{number}"})
    _finish_write_back(spark, path, work, partition_by)
    return len(touched)


def _finish_write_back(spark, path: str, work: str, partition_by: str) -> None:
    note = f"{work}/ready.json"
    if not storage.exists(spark, note):
        return
    rows = spark.read.parquet(f"{work}/{json.loads(storage.read_text(spark, note))['rows']}")
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path))
    storage.delete(spark, note)


def precision(reviewed_alerts: DataFrame) -> DataFrame:
    """Per rule: reviewed count, confirmed count, precision (3 dp) over reviewed alerts."""
    r = reviewed_alerts.where(F.col("reviewed"))
    agg = r.groupBy("final_rule").agg(
        F.count(F.lit(1)).alias("reviewed_count"),
        F.count_if(F.col("true_positive")).alias("confirmed_count"))
    return agg.withColumn("precision", round_half_up(
        F.col("confirmed_count").cast("double") / F.col("reviewed_count").cast("double"), 3))


def confusion(enriched: DataFrame, truth: str = "is_fraud") -> DataFrame:
    """Per final rule: counts against ground truth, precision of the rule."""
    t = F.coalesce(F.col(truth), F.lit(False))
    agg = enriched.groupBy("final_rule").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.count_if(t).alias("actual_fraud"),
        F.count_if(~t).alias("actual_legit"))
    return agg.withColumn("precision", F.when(F.col("final_rule") != "CLEAN", round_half_up(
        F.col("actual_fraud").cast("double") / F.col("txn_count").cast("double"), 3)))


def scorecard(enriched: DataFrame, truth: str = "is_fraud") -> DataFrame:
    """Global confusion matrix of final_is_fraud vs truth with precision and recall."""
    t = F.coalesce(F.col(truth), F.lit(False))
    p = F.col("final_is_fraud")
    agg = enriched.agg(F.count_if(p & t).alias("tp"), F.count_if(p & ~t).alias("fp"),
                       F.count_if(~p & t).alias("fn"), F.count_if(~p & ~t).alias("tn"))
    return (agg.withColumn("precision", round_half_up(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), 3))
            .withColumn("recall", round_half_up(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), 3)))
