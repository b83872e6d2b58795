import random
import re

from pyspark.sql import functions as F

from cardwatch.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=10):
    w = words(text)
    hit, ids = set(), set()
    for item_id, t in items:
        iw = words(t)
        n = min(window, len(iw))
        for k in range(len(iw) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == iw[k:k + n]:
                    hit |= set(range(p, p + n))
                    if item_id is not None:
                        ids.add(str(item_id))
    return len(w), len(hit), sorted(ids)


def check(spark, docs, items, **options):
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = D.search(spark.createDataFrame(docs, "doc_id long, text string, n_words string"), bench, **options).collect()
    assert len(got) == len(docs)
    texts = {d[0]: d[1] for d in docs}
    for r in got:
        spans = list(zip(r["hit_ranges"][::2], r["hit_ranges"][1::2]))
        assert (r["n_words"], sum(e - s for s, e in spans), r["hit_items"]) == brute(texts[r["doc_id"]], items)
    return got


def random_case(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "É", "x1", "zz"]
    draw = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(f"i{k}", draw(rng.choice([0, 1, 3, 9, 10, 11, 25]))) for k in range(8)] + [(None, draw(12)), ("i0", draw(14))]
    docs = [(k, draw(rng.randrange(0, 40)) + ", " + rng.choice(items)[1] + "! " + draw(rng.randrange(0, 30)), "own") for k in range(30)]
    return docs + [(100, None, None), (101, "", None), (102, "...", "x"), (103, docs[0][1], None)], items


def test_matches_brute_force(spark):
    docs, items = random_case(1)
    check(spark, docs, items)


def test_blocks_and_cut_items_change_nothing(spark):
    docs, items = random_case(2)
    items = [i for i in items if len(words(i[1])) >= 10]
    check(spark, docs, items, block_words=15)


def test_longest_match(spark):
    item = " ".join(f"w{k}" for k in range(40))
    got = check(spark, [(1, "x y " + " ".join(f"W{k}" for k in range(5, 33)) + " z", None)], [("i", item)])
    assert got[0]["longest_match"] == 28


def test_decontaminate_drops_only_hits(spark, odd, none):
    prose = "quick brown fox jumps over the lazy dog while nine other"
    bench = spark.createDataFrame([("q", prose)], "item_id string, text string")
    renamed = odd.withColumnRenamed("score", "n_words")
    out = D.decontaminate(renamed, bench)
    assert sorted(out.columns) == sorted(renamed.columns)
    assert out.where(F.col("doc_id").isin(1, 2, 8)).count() == 0 and out.count() == odd.count() - 4
    empty = bench.limit(0)
    assert D.decontaminate(odd, empty).count() == odd.count()
    assert D.decontaminate(none, bench).count() == 0
