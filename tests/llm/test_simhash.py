import numpy as np
import xxhash
from pyspark.sql import functions as F

from cardwatch.llm import registry, simhash


def brute_fp(text, n=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[k:k + n]) for k in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits=4):
    """fps: list of (id, fingerprint); the smallest id of each row's component (None if it has none)."""
    f = np.array([x for _, x in fps], dtype=np.uint64)
    group = list(range(len(f)))
    for k in range(len(f)):
        near = np.flatnonzero(np.bitwise_count(f[k] ^ f) <= bits)
        low = min(group[j] for j in near)
        joined = {group[j] for j in near}
        group = [low if g in joined else g for g in group]
    least = {}
    for (i, _), g in zip(fps, group):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return [least.get(g) for g in group]


def test_xxh64_matches_the_library():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 3000, dtype=np.uint8).tobytes()
    starts = rng.integers(0, 2500, 500)
    ends = starts + rng.integers(0, 150, 500)
    want = [xxhash.xxh64_intdigest(data[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist())]
    assert simhash.xxh64(data, starts, ends).tolist() == want


def test_odd_rows_match_brute_force(spark, odd):
    got = simhash.near_duplicates(odd).collect()
    src = [(r["doc_id"], brute_fp(r["text"])) for r in odd.collect()]
    want = sorted(((i, f"{f:016x}", c) for (i, f), c in zip(src, brute_components(src))), key=str)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == want


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    src = [(r["doc_id"], brute_fp(r["text"])) for r in docs]
    want = {i: (f"{f:016x}", c) for (i, f), c in zip(src, brute_components(src))}
    got = registry.QUERIES["op1_simhash"](spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == want and len(got) == len(src)


def test_large_nodes_are_split_and_lose_no_link(spark):
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 2**62, 6)
    fps = {int(c) ^ int(sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 4), replace=False))) for c in centre for _ in range(60)}
    fps |= {int(x) for x in rng.integers(0, 2**62, 60)}
    table = spark.createDataFrame([(x,) for x in sorted(fps)], "fp long")
    order = [(x, x) for x in sorted(fps)]
    for node_max in (4096, 12):
        tree = simhash.components(simhash.links(table, 4, node_max)).collect()
        root = {r["u"]: r["v"] for r in tree}
        assert [root.get(x, x) for x, _ in order] == brute_components(order)


def test_inner_nodes_prune_but_keep_links():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**62, 150).astype(np.uint64)
    fp = np.unique(np.concatenate([base ^ np.uint64(1 << int(b)) for b in rng.integers(0, 62, 8)] + [base]))
    rank = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    fp = fp[np.argsort(rank)]
    u, v = simhash.index_links(np.zeros(len(fp), dtype=int), fp.view(np.int64), 4, block=1000)
    got, want = simhash.Forest(len(fp)), simhash.Forest(len(fp))
    got.add(u, v)
    for k in range(len(fp)):
        near = np.flatnonzero(np.bitwise_count(fp[k] ^ fp) <= 4)
        want.add(np.full(len(near), k), near)
    assert (got.up == want.up).all()


def test_deduplicate_keeps_one_of_each_component(spark, odd):
    kept = simhash.deduplicate(odd)
    assert kept.columns == odd.columns
    per = simhash.near_duplicates(odd).select("component_id").distinct().count()
    assert kept.count() == per
    # documents 1 and 8 have one text; 2 is five bits away from it, one too many
    assert {r["doc_id"] for r in kept.where("doc_id in (1, 2, 8)").collect()} == {1, 2}


def test_empty_table(spark, none):
    assert simhash.near_duplicates(none).count() == 0 and simhash.deduplicate(none).count() == 0
