"""Token counts with a whole-token shortcut.

Before any text is read, every string of the vocabulary is run through the
merges; those that come out as one token are proven.  A pre-token that is a
proven string counts one without merging; only the rest is merged.

A special token's string inside a text is one token, as the library counts it
by default.

Defined results: null counts like the empty text, 0 tokens and 0 bytes;
repeated rows count alike; extra columns are passed through, columns named like
a result are replaced.

Scale: one pass without a shuffle; the merges (about 50,000 pairs) and the
proven strings are broadcast.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm import common
from cardwatch.llm.bpe import splitter

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Merged pre-tokens that a worker remembers.
REMEMBERED = 400_000
#: Bytes of a piece that is merged pair by pair.
SHORT = 64


def printable_bytes() -> dict[str, int]:
    """The vocabulary's printable characters and the bytes they stand for: printable Latin-1 bytes stand for
    themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class Model:
    """Merge ranks by pair of byte strings, proven strings and special strings."""

    merges: dict[tuple[bytes, bytes], int]
    proven: frozenset[bytes]
    special: tuple[str, ...]


def merged_size(piece: bytes, merges: dict[tuple[bytes, bytes], int]) -> int:
    """Number of tokens that the merges leave of a piece: always the lowest pair, the leftmost first.

    In a short piece the pairs are searched for the lowest each time; in a long
    one a heap holds them, so the time grows with n log n.
    """
    parts = [piece[k:k + 1] for k in range(len(piece))]
    none = 1 << 40
    if len(parts) <= SHORT:
        ranks = [merges.get(p, none) for p in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) < none:
            k = ranks.index(low)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del ranks[k]
            if k:
                ranks[k - 1] = merges.get((parts[k - 1], parts[k]), none)
            if k < len(ranks):
                ranks[k] = merges.get((parts[k], parts[k + 1]), none)
        return len(parts)
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # neighbours of each part that is left
    heap = [(merges[p], k) for k, p in enumerate(zip(parts, parts[1:])) if p in merges]
    heapq.heapify(heap)
    left = n
    while heap:
        rank, k = heapq.heappop(heap)
        other = after[k]
        # a part that is gone is empty, and a pair that has changed has another rank or none
        if other >= n or merges.get((parts[k], parts[other])) != rank:
            continue
        parts[k] += parts[other]
        parts[other] = b""
        left -= 1
        after[k] = after[other]
        if after[k] < n:
            before[after[k]] = k
        for first in (before[k], k):
            if first >= 0 and after[first] < n:
                new = merges.get((parts[first], parts[after[first]]))
                if new is not None:
                    heapq.heappush(heap, (new, first))
    return left


def prove(data: bytes) -> Model:
    """Read a tokenizer file and prove which vocabulary strings are one token alone."""
    spec = json.loads(data)
    byte = printable_bytes()
    raw = lambda s: bytes(byte[c] for c in s)
    pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
    merges = {(raw(a), raw(b)): k for k, (a, b) in enumerate(pairs)}
    special = tuple(t["content"] for t in spec["added_tokens"])
    plain = (raw(t) for t in spec["model"]["vocab"] if t not in special)
    return Model(merges, frozenset(t for t in plain if merged_size(t, merges) == 1), special)


class Counter:
    """Counts tokens of texts with one model."""

    def __init__(self, model: Model, pattern: str):
        self.model = model
        self.find = splitter(pattern)
        self.split = regex.compile("|".join(regex.escape(s) for s in sorted(model.special, key=len, reverse=True))).split if model.special else None
        self.whole = frozenset(t.decode("utf-8") for t in model.proven if _is_text(t))
        self.merged: dict[str, int] = {}

    def size(self, piece: str) -> int:
        n = merged_size(piece.encode("utf-8"), self.model.merges)
        if len(self.merged) >= REMEMBERED:
            self.merged.clear()
        if len(piece) <= 64:
            self.merged[piece] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        runs = self.split(text) if self.split else [text]
        total = len(runs) - 1
        merged, size = self.merged.get, self.size
        for run in runs:
            pieces = self.find(run)
            rest = [p for p in pieces if p not in self.whole]
            total += len(pieces) - len(rest)
            for piece in rest:
                total += merged(piece) or size(piece)
        return total


def _is_text(token: bytes) -> bool:
    try:
        token.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


_counters: dict[tuple, Counter] = {}
FIELDS = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]


def count(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8) and ``n_tokens``; ``vocabulary`` is the path of a tokenizer file on the driver."""
    data = common.file_bytes(vocabulary)
    packed = docs.sparkSession.sparkContext.broadcast(prove(data))
    key = (hashlib.sha256(data).digest(), pattern)

    def make() -> Callable[[pa.Array], dict[str, pa.Array]]:
        if key not in _counters:
            _counters[key] = Counter(packed.value, pattern)
        counter = _counters[key]

        def work(column: pa.Array) -> dict[str, pa.Array]:
            texts = column.to_pylist()
            return {"n_bytes": pa.array([len((t or "").encode("utf-8")) for t in texts], pa.int64()),
                    "n_tokens": pa.array(np.array([counter.count(t) for t in texts], dtype=np.int64))}

        return work

    return common.annotate(docs, text_col, make, FIELDS)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document; over the limit above 1,024."""
    import public_tokenizers

    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return count(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
