"""Spelling variants against brute force over deletion keys."""

import collections
import re
import zlib

import numpy as np
import pytest

from cardwatch.llm import registry, spelling

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def brute_words(rows, delete):
    seen = collections.Counter()
    for id_, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            if delete and h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def brute_variants(words, ratio=10):
    by = collections.defaultdict(set)
    for w in words:
        for k in range(len(w)):
            by[k, w[:k] + w[k + 1:]].add(w)
    near = collections.defaultdict(set)
    for (_, rest), group in by.items():
        for w in group:
            near[w] |= group - {w}
            if rest in words:
                near[w].add(rest)
                near[rest].add(w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= ratio * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()}


def test_op12_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = registry.QUERIES["op12_spelling"](spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_variants(brute_words(rows, True))
    assert {tuple(r) for r in got.collect()} == want and sum(f is not None for _, f, *_ in want) > 0


def counted(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


def hard_words():
    rng = np.random.default_rng(5)
    words = {}
    for length in (7, 8, 9, 30):
        for _ in range(60):
            w = "".join(rng.choice(list("abcàÿ÷"), length))
            words[w] = int(rng.integers(2, 40_000))
            k = int(rng.integers(0, length))
            for v in (w[:k] + w[k + 1:], w[:k] + "z" + w[k:], w[:k] + "é" + w[k + 1:], w[::-1], w[:k] + w[k:][::-1]):
                if len(v) >= 7:
                    words.setdefault(v, int(rng.integers(2, 400)))
    # a chain of forms, and ties between forms
    words |= {"chainaaa": 100_000, "chainaab": 9_000, "chainabb": 800, "chainbbb": 70, "chbinbbb": 7, "tiedword": 5, "tiedworda": 50, "tiedwordb": 50,
              "tiedwor": 50}
    return words


@pytest.mark.parametrize("chunk", [40, spelling.CHUNK])
def test_variants_of_hard_words(spark, monkeypatch, chunk):
    monkeypatch.setattr(spelling, "CHUNK", chunk)
    words = hard_words()
    got = {tuple(r) for r in spelling.variants(counted(spark, words)).collect()}
    assert got == brute_variants(words)
    roots = {r[0]: r[2] for r in got}
    assert roots["chbinbbb"] == "chainaaa" and {r[0]: r[1] for r in got}["tiedword"] == "tiedwor"


def test_small_products_give_the_same(spark, monkeypatch):
    words = hard_words()
    a = np.array([list(w.encode("latin-1")) for w in words if len(w) == 8], np.uint8)
    b = np.array([list(w.encode("latin-1")) for w in words if len(w) == 9], np.uint8)
    whole = set(zip(*spelling.near_pairs(a, b)))
    monkeypatch.setattr(spelling, "COMPARED", 7)
    assert set(zip(*spelling.near_pairs(a, b))) == whole
    i, j = spelling.near_pairs(a, a, range(len(a)))
    assert (j > i).all()


def test_odd_rows(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for delete in (None, 31):
        got = {(r["word"], r["n"]) for r in spelling.words(odd.withColumnRenamed("ids", "word"), delete_every=delete).collect()}
        assert got == set(brute_words(rows, delete).items())


def test_long_words_and_hot_word(spark):
    rows = [(k, "question " * 500 + "x" * 20_000 + " questoin" * (k % 2) + " questions") for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in spelling.variants(spelling.words(docs)).collect()}
    assert got == brute_variants(brute_words(rows, False))


def test_empty_table(none):
    assert spelling.variants(spelling.words(none)).count() == 0
