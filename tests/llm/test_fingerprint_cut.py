"""Paragraphs of op6: cut by content, alike everywhere in a text."""

import random
import re

from pyspark.sql import functions as F

from cardwatch.llm import fingerprint, registry

SF = "/root/testdata/sf0.001"


def sets(spark, *texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", fingerprint.digests(F.col("t")).alias("d"))
    return [set(r["d"]) for r in rows.orderBy("k").collect()]


def prose():
    line = lambda k: " ".join(f"word{k}x{j}" for j in range(5 + 3 * k)) + "."
    return "\n".join(f"{line(k)} {line(k + 20)}" for k in range(12))


def test_words_and_headings_in_front_keep_the_other_paragraphs(spark):
    text = prose()
    assert len(text) > 2_000
    plain, word, heading, sentence = sets(spark, text, "Word " + text, "# A heading\n\n" + text, "A sentence. " + text)
    assert len(plain) >= 24
    assert len(plain - word) == len(word - plain) == 1
    assert plain < heading and plain < sentence and len(heading - plain) == len(sentence - plain) == 1


def test_a_line_has_one_digest_wherever_it_stands(spark):
    line = "x" * 280 + ".\n"
    first, last = sets(spark, line + prose(), prose() + "\n" + line)
    alone, = sets(spark, line)
    assert len(alone) == 1 and alone <= first and alone <= last


def test_long_sentences_are_cut_from_their_own_start(spark):
    long = " ".join(f"w{k}" for k in range(400)) + "。"
    alone, after = sets(spark, long, "Some words in front.\n" + long)
    assert len(alone) > 3 and alone < after and len(after - alone) == 1


def paragraphs(text):
    out, begin, k = set(), 0, 0
    while begin < len(text):
        k = begin
        while k < len(text) and text[k] not in ".!?。！？\n" and k - begin < 300:
            k += 1
        if k < len(text) and text[k] in ".!?。！？\n":
            while k < len(text) and text[k] in ".!?。！？\n \t\r":
                k += 1
        out.add(text[begin:k])
        begin = k
    return out


def test_likeness_is_that_of_the_exact_sets(spark):
    src = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    src.sort(reverse=True)
    jaccard = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    got = {r["doc_id"]: r for r in registry.QUERIES["op6_fingerprint"](spark, SF).collect()}
    assert len(got) == len(src)
    for k, (i, text) in enumerate(src):
        after = src[(k + 1) % len(src)][1]
        third = len(text) // 3
        own = paragraphs(text)
        assert abs(got[i]["near_edited"] - jaccard(own, paragraphs(text[:len(text) - third] + after[:third]))) < 1e-9, i
        assert abs(got[i]["near_next"] - jaccard(own, paragraphs(after))) < 1e-9, i


def test_no_place_in_the_text_changes_the_cut():
    assert re.findall(fingerprint.PARAGRAPH, "a. b!\nc") == ["a. ", "b!\n", "c"]


def test_peeling_recovers_any_difference_and_retries_larger(spark):
    rng = random.Random(9)
    draw = lambda n: [rng.randrange(-2**63, 2**63) for _ in range(n)]
    src = []
    for size, gone, new in [(0, 0, 0), (1, 1, 0), (0, 0, 1), (5, 0, 0), (40, 2, 3), (400, 390, 380), (5_000, 1, 1), (5_000, 4_000, 6_000), (9, 9, 9)] * 5:
        a = draw(size)
        src.append((len(src) % 3, len(src), a, a[gone:] + draw(new), draw(new)))
    rows = spark.createDataFrame(src, "part int, k long, keys array<long>, b array<long>, c array<long>")
    for space in (fingerprint.SPACE, 0.05):
        got = {r["k"]: r for r in fingerprint.differences(rows, ["b", "c"], space).collect()}
        assert len(got) == len(src)
        for _, k, a, b, c in src:
            for name, other in (("b", b), ("c", c)):
                assert got[k][f"plus_{name}"] == len(set(a) - set(other)), (k, name)
                assert got[k][f"minus_{name}"] == len(set(other) - set(a)), (k, name)
    # tables far too small: what is stuck is retried, all else is not
    assert 0 < sum(r["retries"] > 0 for r in got.values()) < len(src) and max(r["retries"] for r in got.values()) > 1


def test_fingerprints_are_sketches_of_the_set(spark):
    rows = spark.createDataFrame([([3, -1, 2**62],), ([2**62, 3, -1],), ([3, -1],), ([],)], "d array<long>")
    got = [r[0] for r in rows.select(fingerprint.sketch(F.col("d"))).collect()]
    cells = 2 * 4 * 4 * fingerprint.TABLES * fingerprint.CELLS
    assert got[0] == got[1] != got[2] and got[3] == "0" * cells and {len(g) for g in got} == {cells}
