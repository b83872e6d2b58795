"""One verdict per transaction and the alert projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch import schema as S
from cardwatch.operators import rules as R
from cardwatch.operators import velocity as V


def resolve(df: DataFrame, mode: str = "reference", window: str = S.VELOCITY_WINDOW) -> DataFrame:
    """final_is_fraud / final_rule from stateless_fraud, fraud_rule and velocity_fraud.

    Velocity outranks any stateless rule.  ``mode='reference'`` keeps the
    stateless confidence/reason on velocity-only hits (0.0 and the clean
    text); ``mode='explain'`` gives them NULL and "n transactions in <window>".
    """
    vel = F.coalesce(F.col("velocity_fraud"), F.lit(False))
    out = (df.withColumn("velocity_fraud", vel)
           .withColumn("final_is_fraud", F.col("stateless_fraud") | vel)
           .withColumn("final_rule", F.when(vel, F.lit(S.RULE_VELOCITY))
                       .when(F.col("stateless_fraud"), F.col("fraud_rule")).otherwise(F.lit(S.RULE_CLEAN))))
    if mode == "explain":
        only_vel = vel & ~F.col("stateless_fraud")
        out = (out.withColumn("fraud_confidence", F.when(only_vel, F.lit(None).cast("double"))
                              .otherwise(F.col("fraud_confidence")))
               .withColumn("fraud_reason", F.when(only_vel, F.format_string(
                   "%d transactions in " + window, F.col("txn_count"))).otherwise(F.col("fraud_reason"))))
    elif mode != "reference":
        raise ValueError(f"unknown mode {mode!r}")
    return out


def enriched(txn: DataFrame, rules: R.RuleSet | None = None, window: str = S.VELOCITY_WINDOW,
             slide: str = S.VELOCITY_SLIDE, threshold: int = S.VELOCITY_MAX_TRANSACTIONS,
             mode: str = "reference") -> DataFrame:
    """Rules + velocity flag + resolution: exactly one row per transaction."""
    scored = R.apply_rules(txn, rules)
    flagged = V.flag(scored, window=window, slide=slide, threshold=threshold)
    return resolve(flagged, mode, window)


#: What an alert holds before it is reviewed.
ALERT_COLUMNS = S.ALERTS_TABLE_COLUMNS[:S.ALERTS_TABLE_COLUMNS.index("alert_time") + 1]


def alerts(enriched_df: DataFrame) -> DataFrame:
    """Fraud-only projection with ``event_time AS alert_time``."""
    return (enriched_df.where(F.col("final_is_fraud"))
            .select(*ALERT_COLUMNS[:-1], F.col("event_time").alias("alert_time")))


def current_alerts(final_alerts: DataFrame, early_alerts: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Alerts as known now: every final alert, plus early (stateless) alerts not yet resolved.

    The early table is written the moment a transaction is scored; the final
    table once its velocity windows have closed, with velocity taking
    priority.  Each transaction appears once; a final verdict replaces the
    early one.  An anti-join on the key (both sides shuffled by it).
    """
    pending = early_alerts.join(final_alerts.select(key), key, "left_anti")
    return final_alerts.unionByName(pending.select(*final_alerts.columns))
