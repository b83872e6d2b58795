"""Queries of the text operators and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardwatch.llm import (bpe, decontaminate, fim, fingerprint, langid, licenses, pii, quality, secrets, simhash, spelling, token_counts,
                           toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": simhash.op1_simhash,
    "op2_bpe": bpe.op2_bpe,
    "op3_quality": quality.op3_quality,
    "op4_langid": langid.op4_langid,
    "op5_pii": pii.op5_pii,
    "op6_fingerprint": fingerprint.op6_fingerprint,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_secrets": secrets.op8_secrets,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_fim": fim.op11_fim,
    "op12_spelling": spelling.op12_spelling,
    "op13_licenses": licenses.op13_licenses,
}

ORACLE_SQL: dict[str, str] = {
    "op10_decontaminate": decontaminate.OP10_SQL,
    "op11_fim": fim.OP11_SQL,
}
