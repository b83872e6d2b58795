"""Learned operators: held-out accuracy on the labelled rows, and defined results for odd rows."""

import pytest
from pyspark.sql import functions as F

from cardwatch.llm import langid, quality, registry, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def held(spark, name, labels, column):
    got = registry.QUERIES[name](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    return got.join(labels, "doc_id").where("held_out").select("score", "predicted", F.col(column).alias("y")).collect()


def test_toxicity_held_out(spark, labels):
    rows = held(spark, "op9_toxicity", labels, "toxic")
    toxic = [r for r in rows if r["y"] == 1]
    clean = [r for r in rows if r["y"] == 0]
    assert sum(r["predicted"] for r in toxic) / len(toxic) >= 0.75
    assert sum(r["predicted"] for r in clean) / len(clean) <= 0.02
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_toxic_spans_and_odd_rows(spark, odd, labels):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train(docs, labels)
    text = "A quiet start. You idiot, you pathetic loser!! And a quiet end."
    table = odd.select("doc_id", "text").union(spark.createDataFrame([(99, text)], "doc_id long, text string"))
    out = {r["doc_id"]: r for r in toxicity.score(table, model).collect()}
    found = [text[s["start"]:s["end"]] for s in out[99]["toxic_spans"]]
    assert any("idiot" in f for f in found) and out[99]["is_toxic"]
    assert out[3]["toxic_score"] == out[4]["toxic_score"] < 0.5 and out[3]["toxic_spans"] == []
    kept = toxicity.score(table, model, only_clean=True)
    assert kept.where("doc_id = 99").count() == 0 and kept.where("doc_id = 8").count() == 2


def test_chain_marginals_against_enumeration():
    import itertools
    import numpy as np

    rng = np.random.default_rng(1)
    grid, move = rng.normal(size=(5, 1)), (0.3, -1.0, 0.2, 0.9)
    weight = {}
    for path in itertools.product((0, 1), repeat=5):
        s = sum(grid[k, 0] * path[k] for k in range(5)) + sum(move[2 * a + b] for a, b in zip(path, path[1:]))
        weight[path] = np.exp(s)
    want = [sum(w for p, w in weight.items() if p[k]) / sum(weight.values()) for k in range(5)]
    assert np.allclose(toxicity.marginals(grid, move)[0][:, 0], want)


def test_quality_held_out(spark, labels):
    rows = held(spark, "op3_quality", labels, "quality")
    assert sum(r["predicted"] == r["y"] for r in rows) / len(rows) >= 0.95


def test_quality_rules_and_odd_rows(spark, odd, none, labels):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(docs, labels)
    assert model.rules and all(len(conditions) <= 6 for conditions, _ in model.rules)
    out = quality.score(odd, model)
    assert out.count() == odd.count() and "score" in out.columns
    by = {r["doc_id"]: r["quality_score"] for r in out.collect()}
    assert by[3] == by[4] and all(0 <= x <= 1 for x in by.values())
    assert quality.score(none, model).count() == 0
    blank = quality.train(none, labels.limit(0))
    assert quality.score(odd, blank).agg(F.max("quality_score")).first()[0] == 0.5


def test_paths_are_read_from_trees():
    text = "Model\n  Tree 0 (weight 1.0):\n    If (feature 1 <= 0.5)\n     If (feature 1 <= 0.25)\n      Predict: 0.0\n     Else (feature 1 > 0.25)\n" \
           "      Predict: 1.0\n    Else (feature 1 > 0.5)\n     Predict: 1.0\n"
    assert quality.paths(text) == [(("letter_share", True, 0.5),), (("letter_share", True, 0.25),),
                                   (("letter_share", False, 0.25), ("letter_share", True, 0.5)), (("letter_share", False, 0.5),)]


def test_language_held_out(spark):
    got = registry.QUERIES["op4_langid"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) >= 0.97


def test_language_of_odd_rows(spark, odd, none):
    model = langid.train(spark.read.parquet(f"{SF}/documents.parquet"))
    table = odd.withColumn("lang_score", F.lit("mine")).union(
        odd.limit(1).withColumns({"doc_id": F.lit(50).cast("long"), "text": F.lit("123 ... ²")}).withColumn("lang_score", F.lit("x")))
    out = {r["doc_id"]: r for r in langid.predict(table, model).collect()}
    assert [out[k]["lang_pred"] for k in (3, 4, 9, 50)] == ["und"] * 4 and out[3]["lang_score"] == 0
    assert out[1]["lang_pred"] in set(model.languages) and 0 <= out[1]["lang_score"] <= 1
    assert langid.predict(none, model).count() == 0
    nothing = langid.train(none)
    assert {r["lang_pred"] for r in langid.predict(odd, nothing).collect()} == {"und"}


def test_no_labels_no_model(spark, odd, none, labels):
    model = toxicity.train(odd, labels.limit(0))
    assert {r["toxic_score"] for r in toxicity.score(odd, model).collect()} == {0.0}
    assert toxicity.score(none, model).count() == 0
