"""License phrases and texts: places against brute force, spans with edits, odd rows."""

import re

import pytest

from cardwatch.llm import licenses, registry

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans(licenses.UPPER, licenses.LOWER)
MIT = dict(licenses.TEXTS)["mit"]


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_base(text):
    w = tokens(text)
    at = [(k, label) for label, p in licenses.PHRASES for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
    places = [k for k, _ in at]
    return (len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at})))


def brute_spans(text, templates, slack=licenses.SLACK):
    """(label, start, end, share) of verified spans, by comparing all grams of the words themselves."""
    w, out = tokens(text), []
    for label, t in templates:
        t = tokens(t)
        k = 2 if len(t) <= 3 else 4
        votes = {}
        for i in range(len(w) - k + 1):
            for j in range(len(t) - k + 1):
                if w[i:i + k] == t[j:j + k]:
                    votes.setdefault(i - j, set()).add(j)
        groups = []
        for d in sorted(votes):
            if not groups or d - groups[-1][-1] > slack:
                groups.append([])
            groups[-1].append(d)
        for g in groups:
            start = min(d + min(votes[d]) for d in g)
            end = max(d + max(votes[d]) + k for d in g)
            covered = {j + x for d in g for j in votes[d] for x in range(k)}
            whole = len(t) <= 3
            share = float(any(len(votes[d]) == len(t) - 1 for d in g)) if whole else len(covered) / len(t)
            if share >= licenses.COVER and (whole or end - start <= licenses.STRETCH * len(t)):
                out.append((start, end, label, share))
    return sorted(out)


def check(docs):
    every = licenses.PHRASES + licenses.TEXTS
    src = sorted([(r["doc_id"], r["text"]) for r in docs.collect()], key=str)
    got = licenses.scan(docs).collect()
    have = sorted([(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"],
                    [tuple(s) for s in r["spans"]]) for r in got], key=str)
    want = []
    for i, t in src:
        base, spans = brute_base(t), brute_spans(t, every)
        want.append((i, *base, ",".join(sorted({s[2] for s in spans})), spans))
    assert have == sorted(want, key=str)
    return {r["doc_id"]: r for r in got}


def test_op13_base_columns_and_spans(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(docs)
    got = registry.QUERIES["op13_licenses"](spark, SF)
    assert got.columns[:8] == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert got.where("base_labels <> ''").count() > 0 and all(0 <= r["score"] <= 1 for r in got.collect())


HARD = [
    (30, "mit license MIT-License mit  license"), (31, "General public GENERAL PUBLIC LICENSE public license general"),
    (32, "intro words " * 20 + MIT + " outro" * 5), (33, MIT.replace("free of charge", "entirely free of any charge")),
    (34, MIT + " and again " + MIT), (35, " ".join(MIT.split()[:8])), (36, "mit license " * 400), (37, "Apache\nLicense général 2.0 licensé"),
    (38, "MIT"), (39, "mitlicense mit license2 mit, license"), (40, "Licensed under CC BY-NC 4.0."),
    (41, "general public public license general public license license"), (42, MIT.replace(" ", " x "))]


def test_hard_texts(spark, odd):
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(HARD, "doc_id long, text string"))
    got = check(docs)
    assert got[32]["labels"] == "mit" and got[33]["labels"] == "mit" and 0.8 <= got[33]["score"] < 1
    assert got[34]["labels"] == "mit" and len(got[34]["spans"]) == 2 and got[34]["base_labels"] == ""
    assert got[35]["labels"] == "" and 0 < got[35]["score"] < 0.8 and got[42]["labels"] == ""
    assert got[36]["n_base"] == 400 and got[3]["n_words"] == 0 and got[3]["score"] == 0.0


def test_templates_in_blocks_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(HARD, "doc_id long, text string")
    whole = sorted(map(str, licenses.scan(docs).collect()))
    monkeypatch.setattr(licenses, "BROADCAST", 20)
    assert sorted(map(str, licenses.scan(docs).collect())) == whole


def test_copies_are_one_row_before_the_shuffle(spark):
    docs = spark.range(0, 600, 1, 4).selectExpr("7L as doc_id", "'Released under the MIT License.' as text", "'x' as labels", "1 as digest")
    got = licenses.scan(docs).collect()
    assert len(got) == 600 and {(r["doc_id"], r["n_base"], r["first_word"], r["labels"]) for r in got} == {(7, 1, 3, "mit")}


def test_a_template_needs_two_words(spark, none):
    with pytest.raises(ValueError):
        licenses.scan(none, texts=[("x", "one")])


def test_empty_table(none):
    assert licenses.scan(none).count() == 0
