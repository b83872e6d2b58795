"""Benchmark decontamination with suffix arrays over the training words.

A task cuts its documents into shards and builds a suffix array of each: the
word positions that can start a match, ordered by the words that follow.  Every
suffix of every benchmark item is binary-searched in every shard; the range
found holds all verbatim occurrences of its first ``window`` words, which are
then lengthened to the longest match.  Documents with a match are removed.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased.  An item
with fewer words than ``window`` (but not none) is a window of its own length.
A word that no benchmark item has ends a match, so positions from which fewer
known words follow than the shortest window has are left out of the array;
this drops no match.

Defined results: a null or wordless text has no words and no hit; items
without words match nothing; an item with a null id hits words but is not
listed; repeated items count once by id; an empty benchmark leaves every
document clean; an empty table gives an empty result.

Scale: documents are not shuffled.  The benchmark goes out in blocks of about
``block_words`` words at most; each block is one pass over
the documents, which carry the ranges found so far.  Spark cuts and deals the
items into blocks in the shared folder; the driver reads and broadcasts one
block at a time, and releases it when its pass is written.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm import common

WINDOW = 10
#: Words of the benchmark that one pass searches for.
BLOCK_WORDS = 500_000
#: Bytes of text in one shard; a longer text is a shard of its own.
SHARD_BYTES = 4_000_000

_AS_WORDS = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """The words of a text, as UTF-8 (every byte of a non-ASCII character is a word byte)."""
    return (text or "").encode("utf-8", "replace").translate(_AS_WORDS).split()


@dataclass
class Block:
    """Part of the benchmark: word numbers from 1, the items' ids and words."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    ids: list[str | None] = field(default_factory=list)
    items: list[np.ndarray] = field(default_factory=list)
    size: int = 0

    def add(self, item_id: str | None, item: list[bytes]) -> None:
        v = self.vocabulary
        self.ids.append(item_id)
        self.items.append(np.array([v.setdefault(w, len(v) + 1) for w in item], dtype=np.uint32))
        self.size += len(item)


PIECES = "id string, words string, n long"


def pieces(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> DataFrame:
    """Items as blank-joined words; one longer than a block is cut with an overlap that keeps every window."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    step = max(block_words - window + 1, 1)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.blocks(batch, "text"):
                out = []
                for id_, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                    item = words(text)
                    begins = range(0, max(len(item) - window + 1, 1), step) if len(item) > block_words else range(min(len(item), 1))
                    out += [(id_, b" ".join(item[k:k + block_words]).decode("utf-8"), min(block_words, len(item) - k)) for k in begins]
                cols = zip(*out) if out else ([], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64()))], ["id", "words", "n"])

    return rows.mapInArrow(cut, PIECES)


class Blocks:
    """The benchmark's blocks: ``count`` of them, read one at a time."""

    def __init__(self, benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int):
        common.ship(benchmark.sparkSession)
        self.rows = pieces(benchmark, id_col, text_col, window, block_words)
        size = self.rows.agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
        total = size["n"] or 0
        self.count, self.folder = 1, None
        if total > block_words:
            # dealt by hash, half full on average, so that hardly any block is larger than asked for
            self.count = -(-2 * total // block_words)
            self.folder = f"{common.shared_folder(benchmark.sparkSession)}/benchmark-{uuid.uuid4().hex}"
            dealt = self.rows.withColumn("block", F.pmod(F.xxhash64("id", "words"), F.lit(self.count)))
            dealt.repartition("block").write.partitionBy("block").parquet(self.folder)

    def read(self, number: int) -> Block:
        rows = self.rows
        if self.folder:
            rows = rows.sparkSession.read.schema(f"{PIECES}, block long").parquet(self.folder).filter(F.col("block") == number)
        block = Block()
        for r in rows.select("id", "words").toLocalIterator():
            block.add(r["id"], r["words"].encode("utf-8").split())
        return block


def keys(rows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort like the rows."""
    wide = np.ascontiguousarray(rows.astype(">u4"))
    return wide.view(f"S{wide.shape[1] * 4}").ravel()


class Searcher:
    """Finds a block's suffixes in shards."""

    def __init__(self, block: Block, window: int):
        self.vocabulary, self.ids, self.window = block.vocabulary, block.ids, window
        flat, owner, place = [], [], []
        for k, item in enumerate(block.items):
            n = max(1, len(item) - window + 1)
            padded = np.concatenate([item, np.zeros(window, dtype=np.uint32)])
            flat.append(np.lib.stride_tricks.sliding_window_view(padded, window)[:n])
            owner += [k] * n
            place += range(n)
        rows = np.concatenate(flat)
        self.owner, self.place = np.array(owner), np.array(place)
        self.size = (rows > 0).sum(axis=1)
        self.low = keys(rows)
        self.high = keys(np.where(rows > 0, rows, np.uint32(0xFFFFFFFF)))
        self.least = int(self.size.min())
        self.text = np.concatenate([np.concatenate([i, np.zeros(1, dtype=np.uint32)]) for i in block.items])
        begins = np.cumsum([0] + [len(i) + 1 for i in block.items])[:-1]
        self.at = begins[self.owner] + self.place

    def shard(self, docs: list[list[bytes]]) -> list[tuple[list[int], list[int], int]]:
        """Per document: merged ranges of hit words (start, end, start, ...), item numbers, longest match in words."""
        out: list[tuple[list[int], list[int], int]] = [([], [], 0)] * len(docs)
        lengths = np.array([len(d) for d in docs], dtype=np.int64)
        begins = np.cumsum(lengths + 1) - lengths - 1
        ids = np.zeros(int(lengths.sum()) + len(docs) + self.window, dtype=np.uint32)
        get = self.vocabulary.get
        for b, d in zip(begins.tolist(), docs):
            ids[b:b + len(d)] = np.fromiter(map(get, d, repeat(0)), dtype=np.uint32, count=len(d))
        stops = np.flatnonzero(ids == 0)
        known = np.flatnonzero(ids)
        follow = stops[np.searchsorted(stops, known)] - known  # known words from here to the next unknown one
        positions = known[follow >= self.least]
        if not len(positions):
            return out
        suffix = keys(np.lib.stride_tricks.sliding_window_view(ids, self.window)[positions])
        order = np.argsort(suffix, kind="stable")
        suffix, positions = suffix[order], positions[order]
        lo, hi = np.searchsorted(suffix, self.low, "left"), np.searchsorted(suffix, self.high, "right")
        test = np.repeat(np.arange(len(lo)), np.maximum(hi - lo, 0))
        if not len(test):
            return out
        n = np.maximum(hi - lo, 0)
        where = positions[np.repeat(lo, n) + np.arange(len(test)) - np.repeat(np.cumsum(n) - n, n)]
        doc = np.searchsorted(begins, where, "right") - 1
        length = self.lengthen(ids, test, where)
        change = np.zeros(len(ids) + 1, dtype=np.int64)
        np.add.at(change, where, 1)
        np.add.at(change, where + self.size[test], -1)
        hit = np.cumsum(change) > 0
        for d in np.unique(doc).tolist():
            b = int(begins[d])
            mark = np.diff(np.concatenate([[0], hit[b:b + lengths[d]].astype(np.int8), [0]]))
            edges = np.sort(np.concatenate([np.flatnonzero(mark > 0), np.flatnonzero(mark < 0)])).tolist()
            out[d] = (edges, [], 0)
        pairs = np.unique(doc * len(self.ids) + self.owner[test])
        longest = np.zeros(len(docs), dtype=np.int64)
        np.maximum.at(longest, doc, length)
        at = np.searchsorted(pairs // len(self.ids), np.arange(len(docs) + 1))
        for d in np.unique(doc).tolist():
            out[d] = (out[d][0], (pairs[at[d]:at[d + 1]] % len(self.ids)).tolist(), int(longest[d]))
        return out

    def lengthen(self, ids: np.ndarray, test: np.ndarray, where: np.ndarray) -> np.ndarray:
        """Length of the longest verbatim match from each occurrence."""
        length = self.size[test].astype(np.int64)
        on = np.arange(len(test))
        while len(on):
            a = self.text[np.minimum(self.at[test[on]] + length[on], len(self.text) - 1)]
            b = ids[np.minimum(where[on] + length[on], len(ids) - 1)]
            on = on[(a == b) & (a > 0)]
            length[on] += 1
        return length


def merged(a: list[int], b: list[int]) -> list[int]:
    """Union of two lists of ranges."""
    if not a or not b:
        return a or b
    out: list[int] = []
    for s, e in sorted(list(zip(a[::2], a[1::2])) + list(zip(b[::2], b[1::2]))):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


FOUND = [T.StructField("n_words", T.LongType()), T.StructField("hit_ranges", T.ArrayType(T.IntegerType())),
         T.StructField("hit_items", T.ArrayType(T.StringType())), T.StructField("longest_match", T.LongType())]


def search(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
           item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_ranges`` (word offsets: start, end, start, ...), ``hit_items`` and ``longest_match`` (words)."""
    common.ship(docs.sparkSession)
    docs = common.without(docs, *[f.name for f in FOUND])
    plain = docs.columns
    schema = T.StructType(list(docs.schema.fields) + FOUND)
    parts = Blocks(benchmark, item_id_col, item_text_col, window, block_words)
    for number in range(parts.count):
        first, last = number == 0, number == parts.count - 1
        packed = docs.sparkSession.sparkContext.broadcast(parts.read(number))

        def run(batches: Iterator[pa.RecordBatch], packed=packed, first=first) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(packed.value, window) if packed.value.size else None
            for batch in batches:
                if not batch.num_rows:
                    continue
                texts = batch.column(text_col).to_pylist()
                before = None if first else [batch.column(f.name).to_pylist() for f in FOUND]
                counts, ranges, items, longest = [], [], [], []
                at = 0
                while at < len(texts):
                    size, shard = 0, []
                    while at < len(texts) and (not shard or size + len(texts[at] or "") <= SHARD_BYTES):
                        size += len(texts[at] or "")
                        shard.append(words(texts[at]))
                        at += 1
                    counts += map(len, shard)
                    for r, i, m in searcher.shard(shard) if searcher else [([], [], 0)] * len(shard):
                        ranges.append(r)
                        items.append(sorted({packed.value.ids[k] for k in i} - {None}))
                        longest.append(m)
                if before:
                    ranges = [merged(a, b) for a, b in zip(before[1], ranges)]
                    items = [sorted({*a, *b}) for a, b in zip(before[2], items)]
                    longest = [max(a, b) for a, b in zip(before[3], longest)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in plain], pa.array(counts, pa.int64()), pa.array(ranges, pa.list_(pa.int32())),
                     pa.array(items, pa.list_(pa.string())), pa.array(longest, pa.int64())], [*plain, *[f.name for f in FOUND]])

        docs = docs.mapInArrow(run, schema)
        if not last:
            docs = common.shared(docs)
            packed.destroy()
    return docs


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a window of a benchmark item."""
    own = {f.name for f in FOUND}
    aside = {c: f"__own_{c}" for c in docs.columns if c.lower() in own}  # columns that are named like a result
    found = search(docs.withColumnsRenamed(aside), benchmark, **options).filter(F.size("hit_ranges") == 0)
    return found.drop(*own).withColumnsRenamed({v: k for k, v in aside.items()})


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a benchmark window of 10 words."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = search(docs, common.table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate(F.transform("hit_ranges", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
                        F.lit(0).cast("long"), lambda total, x: total + x)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("hit_items")), 256).alias("items_sha256"),
        (F.size("hit_ranges") > 0).alias("contaminated"))


OP10_SQL = r"""
WITH bench AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM bench WHERE len(w) > 0)),
docs AS (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)),
found AS (SELECT doc_id, p.n, i, item_id FROM places p JOIN windows v ON p.n = v.n AND p.k = v.k),
hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
