"""Quality, language and secrets against plain Python; pipeline stages on odd rows; columns named like results."""

import collections
import hashlib
import math
import unicodedata

import corpus_pipeline
import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from cardwatch.llm import common, langid, quality, registry, token_counts, toxicity
from test_native import brute_secrets

SF = "/root/testdata/sf0.001"


def plain_features(text):
    t = text or ""
    n = float(len(t))
    letters = [c for c in t if unicodedata.category(c).startswith("L")]
    upper = sum(unicodedata.category(c) == "Lu" for c in t)
    digits = sum(c in "0123456789" for c in t)
    symbols = len(regex.sub(r"[\p{L}\p{N} \t\n\x0b\f\r.,;:'\"?-]+", "", t))
    words = [w for w in regex.split(r"[ \t\n\x0b\f\r]+", t) if w]
    lines = [x for x in t.split("\n") if x]
    share = lambda a, b: a / b if b else 0.0
    return {"log_chars": math.log1p(n), "letter_share": share(len(letters), n), "upper_share": share(upper, len(letters)),
            "symbol_share": share(symbols, n), "digit_share": share(digits, n), "word_length": share(len(letters), len(words)),
            "distinct_words": share(len(set(words)), math.sqrt(len(words))), "distinct_lines": share(len(set(lines)), len(lines)),
            "line_length": math.log1p(share(n, len(lines))),
            "repeated_next": share(sum(a == b for a, b in zip(words, words[1:])), len(words)),
            "short_words": share(sum(len(w) <= 2 for w in words), len(words))}


def test_quality_scores_are_those_of_the_rules(spark, odd):
    docs = common.table(spark, SF, "documents")
    model = quality.train(docs, common.table(spark, SF, "labels"))
    assert len(model.rules) > 1
    rows = docs.select("doc_id", "text").union(odd.select("doc_id", "text"))
    for r in quality.score(rows.withColumn("Quality_Score", F.lit("mine")), model).collect():
        f = plain_features(r["text"])
        # a value within rounding of a rule's bound may fall on either side
        if any(abs(f[n] - b) < 1e-9 for rule, _ in model.rules for n, _, b in rule):
            continue
        total = model.intercept + sum(w for rule, w in model.rules if all(f[n] <= b if most else f[n] > b for n, most, b in rule))
        assert math.isclose(r["quality_score"], 1 / (1 + math.exp(-total)), abs_tol=1e-9), r["doc_id"]


def plain_grams(text):
    """Two- and three-letter grams of the lower-cased text, letters by UTF-8 byte, as places of the model."""
    t = text or ""
    if not any(unicodedata.category(c).startswith("L") for c in t):
        return collections.Counter()
    raw = [32] + [b if 97 <= b < 123 or b >= 128 else 32 for b in t.lower().encode("utf-8", "replace")] + [32, 32]
    out = collections.Counter()
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        if a == 32 and b == 32:
            continue
        for code in (a * 257 + b, (a * 257 + b) * 257 + c + (1 << 20)):
            out[(code * 2654435761 % 2**32) >> 19] += 1
    return out


def test_languages_are_those_of_the_nearest_centroid(spark, odd):
    docs = common.table(spark, SF, "documents")
    model = langid.train(docs)
    rows = docs.select("doc_id", "text").limit(60).union(odd.select("doc_id", "text"))
    for r in langid.predict(rows, model).collect():
        grams = plain_grams(r["text"])
        if not grams:
            assert (r["lang_pred"], r["lang_score"]) == ("und", 0.0)
            continue
        v = {k: math.log1p(n) * float(model.idf[k]) for k, n in grams.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        cosines = [sum(x * float(c[k]) for k, x in v.items()) / norm for c in model.centres]
        best = {}
        for lang, x in zip(model.languages, cosines):
            best[lang] = max(best.get(lang, -1.0), x)
        top = max(best.values())
        assert math.isclose(best[r["lang_pred"]], top, abs_tol=1e-4)
        odds = sorted((math.exp((x - top) / langid.LEAD) for x in best.values()), reverse=True)
        assert math.isclose(r["lang_score"], odds[0] / sum(odds), abs_tol=5e-3)


def test_op8_columns(spark):
    got = {r["doc_id"]: r for r in registry.QUERIES["op8_secrets"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for r in docs:
        spans = brute_secrets(r["text"])
        g = got[r["doc_id"]]
        assert [g[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert g["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) - {""} <= set(g["spans"].split(","))


def test_columns_named_like_results_are_replaced(spark, odd):
    import public_tokenizers as P

    named = odd.withColumns({"N_Tokens": F.lit("x"), "n_bytes": F.lit("y"), "toxic_score": F.lit("z"), "Is_Toxic": F.lit("w")})
    counted = token_counts.count(named, P.path(token_counts.VOCABULARY), P.PATTERN)
    assert counted.columns.count("n_tokens") == 1 and "N_Tokens" not in counted.columns and counted.schema["n_tokens"].dataType.typeName() == "long"
    scored = toxicity.score(named, toxicity.Model())
    assert "Is_Toxic" not in scored.columns and {r["toxic_score"] for r in scored.collect()} == {0.0}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, odd, name, stage):
    """Nulls, empty and long texts, repeated rows, rows without an id and columns named like results."""
    extra = [("toxic_spans", "t"), ("fingerprint", "f"), ("hit_ranges", "h"), ("pii_spans", "p"), ("n_words", "w")]
    given = common.table(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars").withColumn("doc_id", F.col("doc_id") + 1_000)
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars").union(given)
    docs = docs.withColumns({c: F.lit(v) for c, v in extra})
    out = stage(spark, docs, SF)
    rows = out.collect()
    if name != "byte_bpe":
        assert out.columns == docs.columns and all(r["toxic_spans"] == "t" and r["hit_ranges"] == "h" for r in rows)
    kept = collections.Counter(r["doc_id"] for r in rows if r["doc_id"] is None or r["doc_id"] < 1_000)
    every = collections.Counter(r["doc_id"] for r in odd.collect())
    if name == "simhash_near_dedup":
        # 1 and the two rows 8 have one text; 3, 4 and 9 have no word, fingerprint zero
        assert set(kept) & {1, 8} == {1} and set(kept) & {3, 4, 9} == {3} and max(kept.values()) == 1
    else:
        assert kept == every  # nothing here is toxic or in the benchmark
