"""SimHash near-duplicates with a Gray-order hierarchical index.

A document's fingerprint has bit i set if more than half of the hashes of its
word shingles have it set.  Documents whose fingerprints differ in at most
``max_bits`` bits are linked, and linked documents form components.

The index is a hierarchy over the distinct fingerprints.  Its upper nodes are
masked bit patterns: with the free bits cut into ``max_bits + 2`` segments, two
linked fingerprints agree on at least two of them, so every fingerprint goes to
one node per pair of segments, keyed by its bits there.  A node with more than
``NODE_MAX`` fingerprints gets nodes of the next level over its remaining free
bits, so no task holds an unbounded node (with 11 free bits left a node has at
most 2,048 members).  Inside a node the fingerprints are sorted by Gray rank,
runs of neighbours are factored into inner nodes that hold the bits all members
share, and a pair of inner nodes is dropped with all its members as soon as the
differences accumulated on the way down exceed ``max_bits``.  Tasks return a
spanning forest of a node's links, never all pairs.

Defined results: a null or wordless text has fingerprint zero and is linked
like any other; a null id belongs to its text's component but never names one
unless all members' ids are null; repeated rows are linked (difference 0);
an empty table gives an empty result.

Scale: one pass over the texts; what is shuffled are distinct 8-byte
fingerprints, 15 times for 4 bits.  Equal fingerprints are one vertex.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm import common

SEED = 42
#: Fingerprints of one node that a task indexes in memory.
NODE_MAX = 4096
#: Neighbours of a lowest inner node, and nodes of a higher one.
LEAF, FAN = 16, 8
#: Characters of text and shingles handled at once inside a batch.
BLOCK_CHARS, BLOCK_SHINGLES = 2_000_000, 200_000

# The five primes of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64(data: bytes, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of many slices of one byte string at once."""
    buf = np.frombuffer(data + b"\0" * 8, dtype=np.uint8)
    u64 = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
    u32 = np.ndarray((len(buf) - 3,), "<u4", buf, strides=(1,))
    size = (ends - starts).astype(np.int64)
    with np.errstate(over="ignore"):
        s = np.uint64(seed)
        h = np.full(len(starts), s + P5)
        big = np.flatnonzero(size >= 32)
        if len(big):
            lane = [np.full(len(big), x) for x in (s + P1 + P2, s + P2, s, s - P1)]
            at, stripes = starts[big], size[big] // 32
            for k in range(int(stripes.max())):
                on = np.flatnonzero(stripes > k)
                for j in range(4):
                    lane[j][on] = _rotl(lane[j][on] + u64[at[on] + 32 * k + 8 * j] * P2, 31) * P1
            acc = _rotl(lane[0], 1) + _rotl(lane[1], 7) + _rotl(lane[2], 12) + _rotl(lane[3], 18)
            for j in range(4):
                acc = (acc ^ (_rotl(lane[j] * P2, 31) * P1)) * P1 + P4
            h[big] = acc
        h += size.astype(np.uint64)
        at, rest = starts + size // 32 * 32, size % 32
        for k in range(3):
            on = np.flatnonzero(rest >= 8 * (k + 1))
            h[on] = _rotl(h[on] ^ (_rotl(u64[at[on] + 8 * k] * P2, 31) * P1), 27) * P1 + P4
        at, rest = at + rest // 8 * 8, rest % 8
        on = np.flatnonzero(rest >= 4)
        h[on] = _rotl(h[on] ^ (u32[at[on]].astype(np.uint64) * P1), 23) * P2 + P3
        at, rest = at + rest // 4 * 4, rest % 4
        for k in range(3):
            on = np.flatnonzero(rest > k)
            h[on] = _rotl(h[on] ^ (buf[at[on] + k].astype(np.uint64) * P5), 11) * P1
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        return h ^ (h >> np.uint64(32))


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in more than half of the hashes."""
    count = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), BLOCK_SHINGLES):
        part = np.ascontiguousarray(hashes[k:k + BLOCK_SHINGLES])
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(count * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints_of(texts: list[str | None], shingle: int) -> list[int]:
    """Fingerprints (signed 64 bit) of a block of texts."""
    out = [0] * len(texts)
    bodies, owners, counts = [], [], []
    for i, text in enumerate(texts):
        words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: only A-Z change, ASCII white space divides
        if words:
            bodies.append(b" ".join(words))
            owners.append(i)
            counts.append(len(words))
    if not bodies:
        return out
    data = b" ".join(bodies) + b" "
    ends = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = np.array(counts)
    grams = np.maximum(n - shingle + 1, 1)
    first = np.repeat(np.cumsum(n) - n, grams) + np.arange(int(grams.sum())) - np.repeat(np.cumsum(grams) - grams, grams)
    last = first + np.repeat(np.minimum(n, shingle), grams) - 1
    parts = [xxh64(data, starts[first[k:k + BLOCK_SHINGLES]], ends[last[k:k + BLOCK_SHINGLES]])
             for k in range(0, len(first), BLOCK_SHINGLES)]
    hashes, at = np.concatenate(parts), 0
    for i, g in zip(owners, grams.tolist()):
        out[i] = majority(hashes[at:at + g])
        at += g
    return out


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``docs`` with ``fp``, the fingerprint of the whole text as a long."""

    def make() -> Callable[[pa.Array], dict[str, pa.Array]]:
        def work(column: pa.Array) -> dict[str, pa.Array]:
            texts, got, at = column.to_pylist(), [], 0
            while at < len(texts):
                size, to = 0, at
                while to < len(texts) and (to == at or size + len(texts[to] or "") <= BLOCK_CHARS):
                    size += len(texts[to] or "")
                    to += 1
                got += fingerprints_of(texts[at:to], shingle)
                at = to
            return {"fp": pa.array(got, pa.int64())}

        return work

    return common.annotate(docs, text_col, make, [T.StructField("fp", T.LongType())])


def gray_rank(fp: Column) -> Column:
    """Position of the bits in the Gray sequence: neighbours there differ in few bits."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def child_masks(fixed: int, max_bits: int) -> list[int]:
    """Masks one level below a node whose ``fixed`` bits agree: the fixed bits and two segments of the free ones."""
    free = [b for b in range(64) if not fixed >> b & 1]
    cut = [len(free) * k // (max_bits + 2) for k in range(max_bits + 3)]
    segments = [sum(1 << b for b in free[x:y]) for x, y in zip(cut, cut[1:])]
    return [fixed | a | b for a, b in combinations(segments, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class Forest:
    """Components of links between 0..n-1, each by its smallest member."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.up[a], self.up[b]
            on = x != y
            if not on.any():
                return
            a, b, x, y = a[on], b[on], x[on], y[on]
            np.minimum.at(self.up, np.maximum(x, y), np.minimum(x, y))
            while True:
                nxt = self.up[self.up]
                if (nxt == self.up).all():
                    break
                self.up = nxt


def index_links(group: np.ndarray, fp: np.ndarray, max_bits: int, block: int = 400_000) -> tuple[np.ndarray, np.ndarray]:
    """Links, as a spanning forest, inside each group of fingerprints that arrive sorted by group and Gray rank.

    ``group`` numbers the nodes.  Levels are built bottom up from runs of
    ``LEAF`` neighbours; each inner node has the mask and pattern of the bits
    that its members share.  Pairs of nodes descend from the group roots.
    """
    n = len(fp)
    fp = fp.view(np.uint64)
    new = np.concatenate([[True], group[1:] != group[:-1]]) if n else np.zeros(0, dtype=bool)
    begin = np.maximum.accumulate(np.where(new, np.arange(n), 0)) if n else np.zeros(0, dtype=np.int64)
    levels = []
    owner = group
    lo_bits, hi_bits, width = fp, fp, LEAF
    size = n
    while size:
        cut = np.concatenate([[True], (owner[1:] != owner[:-1])])
        base = np.maximum.accumulate(np.where(cut, np.arange(size), 0))
        heads = np.flatnonzero((np.arange(size) - base) % width == 0)
        both, some = np.bitwise_and.reduceat(lo_bits, heads), np.bitwise_or.reduceat(hi_bits, heads)
        levels.append((heads, np.append(heads[1:], size), ~(both ^ some), both))
        one_each = len(heads) == int(cut.sum())
        owner, lo_bits, hi_bits, width, size = owner[heads], both, some, FAN, len(heads)
        if one_each:
            break
    forest = Forest(n)
    if not levels:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    top = len(levels) - 1
    roots = np.arange(len(levels[top][0]))
    zero = np.zeros(len(roots), dtype=np.int64)
    stack = [(top, roots[k:k + block], roots[k:k + block], zero[k:k + block], zero[k:k + block].astype(np.uint64))
             for k in range(0, len(roots), block)]
    while stack:
        level, a, b, acc, done = stack.pop()
        heads, tails, mask, pattern = levels[level]
        common_mask = mask[a] & mask[b]
        acc = acc + np.bitwise_count((pattern[a] ^ pattern[b]) & common_mask & ~done)  # only what upper nodes have not counted
        on = acc <= max_bits
        a, b, acc, done = a[on], b[on], acc[on], common_mask[on]
        if not len(a):
            continue
        na, nb = tails[a] - heads[a], tails[b] - heads[b]
        total = na * nb
        for part in np.array_split(np.arange(len(a)), max(1, int(total.sum()) // block)):
            if not len(part):
                continue
            t = total[part]
            row = np.repeat(part, t)
            k = np.arange(int(t.sum())) - np.repeat(np.cumsum(t) - t, t)
            x, y = heads[a[row]] + k // nb[row], heads[b[row]] + k % nb[row]
            on = x < y if level == 0 else x <= y
            row, x, y = row[on], x[on], y[on]
            if level:
                stack.append((level - 1, x, y, acc[row], done[row]))
                continue
            near = acc[row] + np.bitwise_count((fp[x] ^ fp[y]) & ~done[row]) <= max_bits
            forest.add(x[near], y[near])
    moved = np.flatnonzero(forest.up != np.arange(n))
    return moved, forest.up[moved]


def _link_tasks(nodes: DataFrame, max_bits: int, buffered: int = 1_000_000) -> DataFrame:
    """Links inside each node ``(fixed, p)``; a task handles whole nodes, a million fingerprints at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush(whole: bool) -> pa.RecordBatch | None:
            fixed, p, fp = (np.concatenate(x) for x in zip(*held))
            held.clear()
            new = np.concatenate([[True], (fixed[1:] != fixed[:-1]) | (p[1:] != p[:-1])])
            end = len(fp) if whole else int(np.flatnonzero(new)[-1])  # the last node may go on in the next batch
            if end < len(fp):
                held.append((fixed[end:], p[end:], fp[end:]))
            if not end:
                return None
            u, v = index_links(np.cumsum(new[:end]), fp[:end], max_bits)
            x, y = fp[u], fp[v]
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], ["u", "v"])

        for b in batches:
            if b.num_rows:
                held.append(tuple(b.column(k).to_numpy(zero_copy_only=False) for k in range(3)))
                if sum(len(h[2]) for h in held) >= buffered and (out := flush(False)) is not None:
                    yield out
        if held and (out := flush(True)) is not None:
            yield out

    common.ship(nodes.sparkSession)
    rows = nodes.select("fixed", F.col("fp").bitwiseAND(F.col("fixed")).alias("p"), "fp")
    return (rows.repartition("fixed", "p").sortWithinPartitions("fixed", "p", gray_rank(F.col("fp")))
            .mapInArrow(run, "u long, v long"))


def links(distinct_fps: DataFrame, max_bits: int = 4, node_max: int = NODE_MAX) -> DataFrame:
    """Links (``u`` > ``v``) that connect exactly the distinct ``fp`` within ``max_bits`` of each other, per node a forest."""
    spark = distinct_fps.sparkSession
    found: DataFrame | None = None
    masks = [_signed(m) for m in child_masks(0, max_bits)]
    level = distinct_fps.select("fp", F.explode(F.array(*[F.lit(m) for m in masks])).alias("fixed"))
    while True:
        keyed = level.withColumn("p", F.col("fp").bitwiseAND(F.col("fixed")))
        hot = common.shared(keyed.groupBy("fixed", "p").agg(F.count("*").alias("n")).filter(F.col("n") > node_max).select("fixed", "p"))
        hot_masks = [r["fixed"] for r in hot.select("fixed").distinct().collect()]  # at most 15 by level
        cold = keyed.join(hot, ["fixed", "p"], "left_anti") if hot_masks else keyed
        part = _link_tasks(cold, max_bits)
        found = part if found is None else found.union(part)
        if not hot_masks:
            return found.distinct()
        below = spark.createDataFrame([(m, _signed(c)) for m in hot_masks for c in child_masks(m & (2**64 - 1), max_bits)],
                                      "fixed long, child long")
        level = common.shared(keyed.join(hot, ["fixed", "p"], "left_semi").join(below, "fixed")
                              .select("fp", F.col("child").alias("fixed")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``u``, ``v``: every vertex of ``edges`` that isn't its component's smallest, and the smallest.

    Alternates large and small stars until nothing changes.  Minima are
    partial aggregates, written before they are joined: both sides of a join
    are then plain shuffle reads, and adaptive execution splits a vertex with
    very many links.
    """
    def star(e: DataFrame) -> DataFrame:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = common.shared(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = (both.join(low, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = common.shared(large)
        low = common.shared(large.groupBy("u").agg(F.min("v").alias("m")))
        hung = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        return common.shared(hung.union(low.select("u", F.col("m").alias("v"))).distinct())

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    edges = common.shared(edges)
    before = state(edges)
    while before[0]:
        edges = star(edges)
        now = state(edges)
        if now == before:
            break
        before = now
    return edges


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """Per row of ``docs``: ``id``, ``text_hash``, ``fp``, ``root`` (the component's smallest fingerprint)
    and ``component_id`` (its smallest id)."""
    slim = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    rows = common.shared(fingerprints(slim, "text", shingle).select("id", "text_hash", "fp"))
    vertices = common.shared(rows.groupBy("fp").agg(F.min("id").alias("least_id")))
    tree = components(links(vertices.select("fp"), max_bits))
    rooted = common.shared(vertices.join(tree, vertices["fp"] == tree["u"], "left").select("fp", "least_id", F.coalesce("v", "fp").alias("root")))
    # written, so that the join's sides are plain shuffle reads and a very large component is split
    named = common.shared(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")))
    return rows.join(rooted.join(named, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable by links."""
    return grouped(docs, id_col, text_col, shingle, max_bits).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row per component: that of the smallest id (nulls last), then of the smallest text hash.

    Texts are shuffled once, by id and text hash, to meet the rows that stay.
    """
    rows = grouped(docs, id_col, text_col, shingle, max_bits)
    keep = (rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "text_hash")).alias("k"))
            .select(F.col("k.id").alias("__id"), F.col("k.text_hash").alias("__hash")))
    marked = docs.withColumn("__hash_of_text", F.xxhash64(text_col))
    kept = marked.join(keep, common.quoted(id_col).eqNullSafe(F.col("__id")) & (F.col("__hash_of_text") == F.col("__hash")), "left_semi")
    return kept.dropDuplicates([id_col, "__hash_of_text"]).drop("__hash_of_text")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``documents``: 4-word shingles, 4 bits."""
    return near_duplicates(common.table(spark, sf_dir, "documents"))
