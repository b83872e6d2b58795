"""Fill-in-middle: exact output and rebuilt texts, pieces smaller than the texts, odd rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from cardwatch.llm import fim

HARD = [(20, "a < b <P", None), (21, "x<P>y", None), (22, "x<S>", None), (23, "<M>", None), (24, "> ends and <S starts <", None),
        (25, "𝒳" * 5_000 + "é" * 70_000, None), (26, "<" * 3_000, None), (27, "<P" * 2_000, None), (28, "a", None)]


def expected(id_, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if id_ is None else id_}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    a, b = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return "plain", None, None, text
    if h4 % 100 < 20:
        return "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


def rows_of(odd):
    return odd.select("doc_id", "text", "ids").union(odd.sparkSession.createDataFrame(HARD, "doc_id long, text string, ids string"))


@pytest.mark.parametrize("chunk", [1, 7, fim.CHUNK])
def test_outputs_and_rebuilt_texts(odd, chunk):
    docs = rows_of(odd).withColumn("text", F.left("text", F.lit(2_000))) if chunk < 10 else rows_of(odd)
    src = [(r["doc_id"], r["text"]) for r in docs.collect()]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for i, t in src:
        form, a, m, out = expected(i, t)
        want.append((None if i is None else str(i), len(t or ""), form, a, m, sha(out), sha(t or "")))
    pieces = fim.pieces(docs, chunk=chunk)
    got = [tuple(r) for r in fim.digests(fim.restored(pieces)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    texts = [tuple(r) for r in fim.texts(pieces).collect()]
    assert sorted(texts, key=str) == sorted([(None if i is None else str(i), *expected(i, t)[::3]) for i, t in src], key=str)
    assert pieces.agg(F.max(F.length("piece"))).first()[0] <= chunk + 3


def test_every_form_occurs_and_both_are_rebuilt(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), "id").alias("text"))
    got = fim.digests(fim.restored(fim.pieces(docs, chunk=3))).collect()
    assert {r["form"] for r in got} == {"plain", "psm", "spm"} and len(got) == 400
    assert all(r["restored_sha256"] == hashlib.sha256(f"text number {r['id']}".encode()).hexdigest() for r in got)


def test_copies_spread_over_the_input_partitions(spark):
    docs = spark.range(0, 300, 1, 10).select(F.lit(7).alias("doc_id"), F.lit("one text for all").alias("text"))
    pieces = fim.pieces(docs)
    assert pieces.select("key").distinct().count() == 10
    assert fim.digests(fim.restored(pieces)).count() == 300


def test_one_shuffle(spark, odd):
    plan = fim.digests(fim.restored(fim.pieces(odd)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 2


def test_empty_table(none):
    assert fim.digests(fim.restored(fim.pieces(none))).count() == 0 and fim.texts(fim.pieces(none)).count() == 0
