"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the ``events`` table of ``sf_dir`` (through
``fixtures.transactions``) and runs over all of it.  Velocity queries use the
fixture parameters (24 h window, 4 h slide, > 6), because the original 60 s
setting finds no burst in the test events; ``rapid_use`` keeps its own 60 s
definition.  Output decimals are cast to double so that both engines' values
compare exactly; the DuckDB text of each query is in ``plans.oracle``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch import schema as S
from cardwatch.operators import enrich, feedback, quality, rules, tables, velocity, verdict
from cardwatch.plans import reports
from cardwatch.sources import codec, fixtures, sinks

FIXTURE_WINDOW = "24 hours"
FIXTURE_SLIDE = "4 hours"
FIXTURE_THRESHOLD = 6
AS_OF = "2024-02-01 00:00:00"
INSERT_TARGET_BEFORE = "2024-01-16 00:00:00"
INSERT_BATCH_FROM = "2024-01-10 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def _as_of() -> F.Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def _doubles(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


# ----------------------------------------------------------------- shared plans
def txn(spark, d) -> DataFrame:
    return fixtures.transactions(spark, d)


def enriched(spark, d) -> DataFrame:
    return verdict.enriched(txn(spark, d), window=FIXTURE_WINDOW, slide=FIXTURE_SLIDE, threshold=FIXTURE_THRESHOLD)


def txn_table(spark, d) -> DataFrame:
    return tables.to_transactions_table(enriched(spark, d), created_at=_as_of())


def alerts_table(spark, d) -> DataFrame:
    return tables.to_alerts_table(verdict.alerts(enriched(spark, d)), created_at=_as_of())


def reviewed_alerts(spark, d) -> DataFrame:
    a = alerts_table(spark, d)
    return feedback.apply(a, fixtures.reviews(a))


def defective_records(spark, d, keep_event_id: bool = False, keep: list[str] | None = None) -> DataFrame:
    """F1 with defects in 13 of 40 events (kinds 0-12 by event id; 12 is a valid lower-case time), as JSON text.

    ``keep`` carries other columns of the transactions beside the event id.
    """
    t = fixtures.transactions(spark, d, keep_event_id=True)
    k = F.col("event_id") % 40
    t = (t.withColumn("amount", F.when(k == 0, -F.col("amount")).when(k == 1, F.lit(float("nan")))
                      .when(k == 9, F.lit(None).cast("double")).when(k == 10, F.lit(1e12)).otherwise(F.col("amount")))
         .withColumn("currency", F.when(k == 2, F.lit("USDX")).otherwise(F.col("currency")))
         .withColumn("card_last4", F.when(k == 3, F.lit("12a4")).otherwise(F.col("card_last4")))
         .withColumn("merchant_category", F.when(k == 4, F.lit("casino")).otherwise(F.col("merchant_category")))
         .withColumn("timestamp", F.when(k == 5, F.lit("not-a-time")).when(k == 11, F.lit("2024-02-30T10:00:00Z"))
                     .when(k == 12, F.lower("timestamp")).otherwise(F.col("timestamp")))
         .withColumn("transaction_id", F.when(k == 6, F.lit(None).cast("string"))
                     .when(k == 8, F.concat(F.lit("txn-"), F.col("event_id").cast("string")))
                     .otherwise(F.col("transaction_id")))
         .withColumn("card_type", F.when(k == 7, F.lit("prepaid")).otherwise(F.col("card_type"))))
    if keep_event_id:
        fields = [f for f in S.TRANSACTION_FIELDS if f != "device_id"]
        return t.select("event_id", F.col("user_id").alias("key"), codec.json_value(fields).alias("value"), *(keep or []))
    return codec.encode(t)


VALIDATION_COLUMNS = ["transaction_id", "user_id", "currency", "merchant_category", "card_type",
                      "card_last4", "timestamp", "violations", "is_valid"]


def validated(spark, d) -> DataFrame:
    return quality.validate(codec.decode(defective_records(spark, d)))


# ----------------------------------------------------------------- queries
def q_txn_projection(spark, d):
    return txn(spark, d)


def q_json_roundtrip(spark, d):
    return codec.decode(codec.encode(txn(spark, d)))


def q_publish_records(spark, d):
    """Keyed records (key = user id, value = JSON) published to storage, read back and decoded."""
    import os
    import uuid

    from cardwatch.session import ensure_checkpoint_dir
    path = os.path.join(ensure_checkpoint_dir(spark), "cardwatch-published", uuid.uuid4().hex[:12])
    sinks.publish(txn(spark, d), fmt="parquet", path=path)
    return codec.decode(spark.read.parquet(path), keep=["key"])


def q_event_time_parse(spark, d):
    t = codec.with_event_time(codec.decode(codec.encode(txn(spark, d))), out="parsed_time")
    return t.select("transaction_id", "timestamp", "parsed_time",
                    rules.hour_as_written(F.col("timestamp")).alias("written_hour"))


def q_validate_transactions(spark, d):
    return validated(spark, d).select(*VALIDATION_COLUMNS)


def q_quality_report(spark, d):
    return quality.report(validated(spark, d))


def q_enrich_merchant(spark, d):
    t = txn(spark, d).select("transaction_id", "merchant_id")
    return enrich.merchant(t, enrich.merchant_dimension(spark, fixtures.FIXTURE_MERCHANTS))


def q_enrich_international(spark, d):
    t = txn(spark, d).select("transaction_id", "user_id", "merchant_country")
    return enrich.international(t, fixtures.users(spark, d))


def q_enrich_currency(spark, d):
    return enrich.currency(txn(spark, d).select("transaction_id", "merchant_country"))


def _rule_query(rule):
    def q(spark, d):
        s = txn(spark, d).withColumn("_s", rule())
        return s.select("transaction_id", F.col("_s.rule_name").alias("rule_name"),
                        F.col("_s.confidence").alias("confidence"), F.col("_s.reason").alias("reason"))
    return q


def q_rule_first_match(spark, d):
    return rules.apply_rules(txn(spark, d)).select(
        "transaction_id", "stateless_fraud", "fraud_rule", "fraud_confidence", "fraud_reason")


def q_rule_all_matches(spark, d):
    m = rules.stateless_rules().all_matches()
    return txn(spark, d).select("transaction_id", rules.signal_names(m).alias("matched_rules"),
                                F.size(m).alias("match_count"))


def _homes(spark, d) -> DataFrame:
    return enrich.international(txn(spark, d), fixtures.users(spark, d))


def _label_query(rule, needs_home: bool = False):
    """A label rule on its own; only a rule that reads the user's home country joins the user table."""
    def q(spark, d):
        t = _homes(spark, d) if needs_home else txn(spark, d)
        return t.select("transaction_id", rule().isNotNull().alias("fired"))
    return q


def q_label_set(spark, d):
    t = velocity.rapid_use(_homes(spark, d))
    lab = rules.label_rules().first_match()
    return t.select("transaction_id", "rapid_count", "rapid_use",
                    F.when(lab["is_fraud"], lab["rule_name"]).otherwise(F.lit("NONE")).alias("label"),
                    lab["is_fraud"].alias("labelled_fraud"))


def q_velocity_windows(spark, d):
    return velocity.windows(txn(spark, d), FIXTURE_WINDOW, FIXTURE_SLIDE, FIXTURE_THRESHOLD)


def q_velocity_join_windows(spark, d):
    j = velocity.join_windows(txn(spark, d), window=FIXTURE_WINDOW, slide=FIXTURE_SLIDE,
                              threshold=FIXTURE_THRESHOLD, how="left")
    return j.select("transaction_id", "user_id", "event_time", "velocity_window_start", "txn_count")


def q_velocity_flag(spark, d):
    f = velocity.flag(txn(spark, d), window=FIXTURE_WINDOW, slide=FIXTURE_SLIDE, threshold=FIXTURE_THRESHOLD)
    return f.select("transaction_id", "user_id", "velocity_fraud", "txn_count")


def q_velocity_trailing(spark, d):
    t = velocity.trailing(txn(spark, d), FIXTURE_WINDOW, FIXTURE_THRESHOLD)
    return t.select("transaction_id", "user_id", "trailing_count", "trailing_fraud")


def q_velocity_trailing_split(spark, d):
    t = velocity.trailing_split(txn(spark, d), FIXTURE_WINDOW, FIXTURE_THRESHOLD)
    return t.select("transaction_id", "user_id", "trailing_count", "trailing_fraud")


def q_rapid_use(spark, d):
    return velocity.rapid_use(txn(spark, d)).select("transaction_id", "user_id", "rapid_count", "rapid_use")


ENRICHED_COLUMNS = ["transaction_id", "user_id", "amount", "merchant_category", "event_time",
                    "stateless_fraud", "fraud_rule", "fraud_confidence", "fraud_reason",
                    "txn_count", "velocity_fraud", "final_is_fraud", "final_rule", "is_fraud"]


def q_enriched_transactions(spark, d):
    return enriched(spark, d).select(*ENRICHED_COLUMNS)


def q_fraud_alerts(spark, d):
    return verdict.alerts(enriched(spark, d))


def q_transactions_table(spark, d):
    return _doubles(txn_table(spark, d))


def q_alerts_table(spark, d):
    return _doubles(alerts_table(spark, d))


def q_insert_if_absent(spark, d):
    t = txn_table(spark, d)
    target = t.where(F.col("event_time") < F.lit(INSERT_TARGET_BEFORE).cast("timestamp_ntz"))
    batch = t.where(F.col("event_time") >= F.lit(INSERT_BATCH_FROM).cast("timestamp_ntz"))
    return _doubles(sinks.new_rows(batch.unionByName(batch), target))


def q_insert_indexed(spark, d):
    """The whole transactions table written in three overlapping batches through the key filters, and read back."""
    import os
    import uuid

    from cardwatch.session import ensure_checkpoint_dir
    path = os.path.join(ensure_checkpoint_dir(spark), "cardwatch-indexed", uuid.uuid4().hex[:12])
    t = txn_table(spark, d).withColumn("event_date", F.to_date("event_time"))
    before = F.col("event_time") < F.lit(INSERT_TARGET_BEFORE).cast("timestamp_ntz")
    after = F.col("event_time") >= F.lit(INSERT_BATCH_FROM).cast("timestamp_ntz")
    for part in (t.where(before), t.where(after), t):
        sinks.insert_if_absent(part, path, partition_by=["event_date"], key_index=True)
    return _doubles(spark.read.parquet(path).drop("event_date"))


def q_review_writeback(spark, d):
    """Reviews set in the stored alerts table, in the partitions that hold them; the table read back."""
    import os
    import uuid

    from cardwatch.session import ensure_checkpoint_dir
    path = os.path.join(ensure_checkpoint_dir(spark), "cardwatch-reviewed", uuid.uuid4().hex[:12])
    alerts_table(spark, d).withColumn("event_date", F.to_date("alert_time")).write.partitionBy("event_date").parquet(path)
    stored = spark.read.parquet(path)
    feedback.write_back(spark, path, fixtures.reviews(stored))
    return _doubles(spark.read.parquet(path).drop("event_date"))


def threshold_versions(spark) -> DataFrame:
    """The thresholds in force from the start, and stricter ones for half of the categories from the middle of the month on."""
    first = [(c, float(v), "2000-01-01 00:00:00") for c, v in S.CATEGORY_THRESHOLDS.items()]
    second = [(c, float(v) / 2, "2024-01-16 12:00:00") for c, v in S.CATEGORY_THRESHOLDS.items() if v >= 1500]
    rows = enrich.literal_table(spark, first + second, ["merchant_category", "threshold", "valid_from"])
    return rows.withColumn("valid_from", F.col("valid_from").cast("timestamp_ntz"))


def asof_signals(txn: DataFrame) -> DataFrame:
    """The high-amount rule with the thresholds in force at each transaction's time."""
    s = rules.thresholds_asof(txn, threshold_versions(txn.sparkSession)).withColumn("_s", rules.high_amount(threshold="threshold"))
    return s.select("transaction_id", "threshold", F.col("_s.rule_name").alias("rule_name"),
                    F.col("_s.confidence").alias("confidence"), F.col("_s.reason").alias("reason"))


def q_rule_high_amount_asof(spark, d):
    return asof_signals(txn(spark, d))


def q_fraud_metrics(spark, d):
    return reports.fraud_metrics(txn_table(spark, d))


def q_rule_performance(spark, d):
    return reports.rule_performance(alerts_table(spark, d))


def q_pipeline_summary(spark, d):
    return reports.summary(txn_table(spark, d), _as_of())


def q_summary_long(spark, d):
    return reports.summary_long(reports.summary(txn_table(spark, d), _as_of()))


def q_amount_sample(spark, d):
    return reports.amount_sample(txn_table(spark, d))


def q_amount_histogram(spark, d):
    return reports.amount_histogram(txn_table(spark, d))


def q_alerts_by_rule(spark, d):
    return reports.alerts_by_rule(alerts_table(spark, d))


def q_top_risk_users(spark, d):
    return reports.top_users(txn_table(spark, d))


def q_running_totals(spark, d):
    return reports.running_totals(txn_table(spark, d))


def q_review_queue(spark, d):
    return _doubles(feedback.queue(reviewed_alerts(spark, d)))


def q_review_apply(spark, d):
    return _doubles(reviewed_alerts(spark, d))


def q_rule_precision(spark, d):
    return feedback.precision(reviewed_alerts(spark, d))


def q_confusion(spark, d):
    return feedback.confusion(enriched(spark, d))


def q_hourly_series(spark, d):
    """The hourly series ascending, through the named SQL view."""
    reports.register_views(txn_table(spark, d), alerts_table(spark, d), prefix="cw_")
    return spark.sql("SELECT * FROM cw_fraud_metrics ORDER BY hour")


def q_enriched_explain(spark, d):
    e = verdict.enriched(txn(spark, d), window=FIXTURE_WINDOW, slide=FIXTURE_SLIDE,
                         threshold=FIXTURE_THRESHOLD, mode="explain")
    return e.select("transaction_id", "final_rule", "fraud_confidence", "fraud_reason")


def q_velocity_flag_expansion(spark, d):
    f = velocity.flag_by_expansion(txn(spark, d), window=FIXTURE_WINDOW, slide=FIXTURE_SLIDE,
                                   threshold=FIXTURE_THRESHOLD)
    return f.select("transaction_id", "user_id", "velocity_fraud", "txn_count")


def q_scorecard(spark, d):
    return feedback.scorecard(enriched(spark, d))


QUERIES: dict[str, Query] = {
    "txn_projection": q_txn_projection,
    "json_roundtrip": q_json_roundtrip,
    "publish_records": q_publish_records,
    "event_time_parse": q_event_time_parse,
    "validate_transactions": q_validate_transactions,
    "quality_report": q_quality_report,
    "enrich_merchant": q_enrich_merchant,
    "enrich_international": q_enrich_international,
    "enrich_currency": q_enrich_currency,
    "rule_high_amount": _rule_query(rules.high_amount),
    "rule_international_atm": _rule_query(rules.international_atm),
    "rule_odd_hours": _rule_query(rules.odd_hours),
    "rule_first_match": q_rule_first_match,
    "rule_all_matches": q_rule_all_matches,
    "rule_geo_anomaly": _label_query(rules.geo_anomaly, needs_home=True),
    "rule_off_hours_atm": _label_query(rules.off_hours_atm),
    "rule_extreme_amount": _label_query(rules.extreme_amount),
    "label_set": q_label_set,
    "velocity_windows": q_velocity_windows,
    "velocity_join_windows": q_velocity_join_windows,
    "velocity_flag": q_velocity_flag,
    "velocity_trailing": q_velocity_trailing,
    "velocity_trailing_split": q_velocity_trailing_split,
    "rapid_use": q_rapid_use,
    "enriched_transactions": q_enriched_transactions,
    "fraud_alerts": q_fraud_alerts,
    "transactions_table": q_transactions_table,
    "alerts_table": q_alerts_table,
    "insert_if_absent": q_insert_if_absent,
    "insert_indexed": q_insert_indexed,
    "review_writeback": q_review_writeback,
    "rule_high_amount_asof": q_rule_high_amount_asof,
    "fraud_metrics": q_fraud_metrics,
    "rule_performance": q_rule_performance,
    "pipeline_summary": q_pipeline_summary,
    "summary_long": q_summary_long,
    "amount_sample": q_amount_sample,
    "amount_histogram": q_amount_histogram,
    "alerts_by_rule": q_alerts_by_rule,
    "top_risk_users": q_top_risk_users,
    "running_totals": q_running_totals,
    "review_queue": q_review_queue,
    "review_apply": q_review_apply,
    "rule_precision": q_rule_precision,
    "confusion": q_confusion,
    "scorecard": q_scorecard,
    "hourly_series": q_hourly_series,
    "enriched_explain": q_enriched_explain,
    "velocity_flag_expansion": q_velocity_flag_expansion,
}


def _register_streams() -> None:
    from cardwatch.plans.streams import STREAM_QUERIES
    QUERIES.update(STREAM_QUERIES)


_register_streams()
