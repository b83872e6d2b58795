"""Byte-level BPE: encoding by backtracking over longest matches, and decoding.

Bytes become Latin-1 characters, so a string automaton over the vocabulary
finds, for every start in a piece, the longest token there.  Encoding takes the
longest token; if it is not compatible with the token before, it tries the next
shorter one, and goes back a token when none is left.  A sequence is what the
merges by rank produce exactly if all its neighbours are compatible, that is,
if merging the bytes of two neighbours gives these two again.  Compatibility is
remembered by pair and positions found impossible are not tried again, so the
time is linear in the piece.

Defined results: null is encoded like the empty text, to no ids; every text
round-trips to its UTF-8 bytes; repeated rows are encoded alike; extra columns
are passed through, columns named like a result are replaced.

Scale: one pass without a shuffle; the vocabulary (50,256 tokens) is broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import unicodedata
from collections.abc import Callable

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm import common

#: Pieces whose ids, and token pairs whose compatibility, a worker remembers.
REMEMBERED, REMEMBERED_PAIRS = 300_000, 500_000
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Code points below this take the fast form of the pattern.
LATIN = 0x250
#: White space as the merges' own library knows it; the pattern's ``\s`` stands for it.
SPACE = r"\p{White_Space}"


def explicit(pattern: str) -> str:
    """The pattern with its white-space classes written out, so that every regex library reads them alike."""
    return pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")


def _ranges(test: Callable[[str], bool]) -> str:
    """The Latin code points that pass a test, as the inside of a character class."""
    out, k = "", 0
    while k < LATIN:
        if test(chr(k)):
            to = k
            while to + 1 < LATIN and test(chr(to + 1)):
                to += 1
            out += f"\\u{k:04x}-\\u{to:04x}"
            k = to
        k += 1
    return out


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """A function that finds a text's pieces.

    For texts of Latin characters the pattern's classes are written out as
    ranges, which the standard library matches about twice as fast; any other
    text takes the full pattern.
    """
    kinds = {r"\p{L}": _ranges(lambda c: unicodedata.category(c)[0] == "L"), r"\p{N}": _ranges(lambda c: unicodedata.category(c)[0] == "N"),
             r"\s": r"\t-\r \x85\xa0"}
    short = re.sub(r"\[[^\]]*\]", lambda m: _spelled(m[0], kinds, "{}"), pattern)
    short = re.sub(r"(\[[^\]]*\])|(\\p\{[LN]\}|\\[sS])", lambda m: m[1] or (f"[^{kinds[chr(92) + 's']}]" if m[2] == r"\S" else f"[{kinds[m[2]]}]"), short)
    beyond = re.compile(f"[^\\u0000-\\u{LATIN - 1:04x}]").search
    fast, full = re.compile(short).findall, regex.compile(explicit(pattern)).findall
    return lambda text: full(text) if beyond(text) else fast(text)


def _spelled(part: str, kinds: dict[str, str], form: str) -> str:
    for name, inside in kinds.items():
        part = part.replace(name, form.format(inside))
    return part


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks from lines of a base64 token and its rank."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in data.splitlines() if line)}


class Encoder:
    """Encodes and decodes with one set of ranks and one pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.sizes = {r: len(t) for t, r in ranks.items()}
        self.find = splitter(pattern)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.shorter: dict[int, int] = {}
        self.fits: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[bytes]:
        """The plain merges: always the pair of lowest rank, the leftmost first."""
        parts = [piece[k:k + 1] for k in range(len(piece))]
        rank = self.ranks.get
        none = 1 << 40
        pairs = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs and (low := min(pairs)) < none:
            k = pairs.index(low)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k:
                pairs[k - 1] = rank(parts[k - 1] + parts[k], none)
            if k < len(pairs):
                pairs[k] = rank(parts[k] + parts[k + 1], none)
        return parts

    def compatible(self, a: int, b: int) -> bool:
        """True if merging the bytes of two tokens gives these two again; remembered by pair."""
        pair = [self.tokens[a], self.tokens[b]]
        got = self.merge(pair[0] + pair[1]) == pair
        if len(self.fits) >= REMEMBERED_PAIRS:
            self.fits.clear()
        self.fits[a << 32 | b] = got
        return got

    def prefix(self, token: int) -> int:
        """The longest token that is a proper beginning of this one, or -1."""
        raw = self.tokens[token]
        self.shorter[token] = next((self.ranks[raw[:k]] for k in range(len(raw) - 1, 0, -1) if raw[:k] in self.ranks), -1)
        return self.shorter[token]

    def backtrack(self, piece: bytes) -> list[int]:
        """The merges' tokens of a piece."""
        n = len(piece)
        sizes, fits, shorter = self.sizes, self.fits, self.shorter
        reach = [0] * n  # longest token from each start: ends come in order, so a later match is a longer one
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            reach[end - sizes[token] + 1] = token
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, reach[0]
        while True:
            end = at + sizes[token]
            ok = not dead[end]
            if ok and out:
                got = fits.get(out[-1] << 32 | token)
                ok = self.compatible(out[-1], token) if got is None else got
            if ok:
                out.append(token)
                at = end
                if at == n:
                    return out
                token = reach[at]
                continue
            token = shorter[token] if token in shorter else self.prefix(token)
            while token < 0:
                # nothing fits here: this position is impossible, shorten the token before it
                dead[at] = 1
                token = out.pop()
                at -= sizes[token]
                token = shorter[token] if token in shorter else self.prefix(token)

    def ids_of(self, piece: str) -> bytes:
        """Ids of one piece as little-endian 32-bit integers."""
        raw = piece.encode("utf-8")
        whole = self.ranks.get(raw)
        ids = [whole] if whole is not None else self.backtrack(raw)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if len(piece) <= 64:
            self.known[piece] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        pieces = self.find(text or "")
        got = list(map(self.known.get, pieces))
        if None in got:
            got = [self.ids_of(p) if g is None else g for p, g in zip(pieces, got)]
        return b"".join(got)

    def decode(self, packed: bytes) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


_encoders: dict[tuple[bytes, str], Encoder] = {}


def encoder(data: bytes, pattern: str) -> Encoder:
    """This worker's encoder for a vocabulary; it keeps what it remembers from task to task."""
    key = (hashlib.sha256(data).digest(), pattern)
    if key not in _encoders:
        _encoders[key] = Encoder(read_ranks(data), pattern)
    return _encoders[key]


IDS = T.StructField("ids", T.ArrayType(T.IntegerType(), False))
SIZE = T.StructField("n_tokens", T.LongType())
DIGESTS = [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]


def encode(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` (of the ids decoded again) and, on request, ``ids``.

    ``vocabulary`` is the path of a rank file on the driver.
    """
    packed = docs.sparkSession.sparkContext.broadcast(common.file_bytes(vocabulary))

    def make() -> Callable[[pa.Array], dict[str, pa.Array]]:
        coder = encoder(packed.value, pattern)

        def work(column: pa.Array) -> dict[str, pa.Array]:
            got = [coder.encode(t) for t in column.to_pylist()]
            sizes = np.array([len(g) // 4 for g in got], dtype=np.int64)
            out = {"n_tokens": pa.array(sizes),
                   "ids_sha256": pa.array([hashlib.sha256(g).hexdigest() for g in got], pa.string()),
                   "decoded_sha256": pa.array([hashlib.sha256(coder.decode(g)).hexdigest() for g in got], pa.string())}
            if with_ids:
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                out["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(got), dtype="<i4")))
            return out

        return work

    return common.annotate(docs, text_col, make, [SIZE, *DIGESTS, *([IDS] if with_ids else [])])


def decode(rows: DataFrame, vocabulary: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the bytes that the ids stand for (null ids: no bytes)."""
    packed = rows.sparkSession.sparkContext.broadcast(common.file_bytes(vocabulary))
    common.ship(rows.sparkSession)
    rows = common.without(rows, "decoded")

    def run(batches):
        coder = encoder(packed.value, pattern)
        for b in batches:
            new = [coder.decode(np.array(x or [], dtype="<u4").tobytes()) for x in b.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(new, pa.binary())], [*b.schema.names, "decoded"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())]))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document and decode the ids."""
    import public_tokenizers

    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, with_ids=False).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
