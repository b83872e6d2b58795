"""Fill-in-middle transformation by secondary-sort assembly.

A text is cut at two places, fixed by a hash of its id, into prefix, middle and
suffix.  It is emitted as pieces of at most ``CHUNK`` code points, keyed by the
row and by the piece's position in the output.  One shuffle by row and a sort
by position within partitions (the DataFrame form of
``repartitionAndSortWithinPartitions``) bring the pieces into output order, so
a task streams them into an incremental digest and never holds a whole text.
The same stream is taken apart again at the sentinels it holds, keyed by
position in the original text and sorted a second time, without a shuffle: what
comes out is the text rebuilt from output and form.

Units are code points.  Forms: ``plain``, ``psm`` (prefix, suffix, middle) and
``spm`` (suffix first).  A sentinel starts with ``<`` and texts with a sentinel
stay plain, so in an output each sentinel stands in one place only.

Defined results: null and empty texts are plain with n 0; a null id counts as
the empty string in the hash; rows that repeat id and text get the same result
each; rows of one id with different texts are separate; an empty table gives an
empty result; columns other than id and text are not read.

Scale: a text crosses the network once.  The key holds the input partition, so
copies of a row (up to a third of all) spread over as many tasks as the input
has partitions.  The key is a function of row and partition: a task that is run
again emits the same pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm import common

P, S, M = "<P>", "<S>", "<M>"
SENTINELS = (P, S, M)
#: Code points of a piece, at most.
CHUNK = 65_536
#: Characters of pieces that a task hands over at once, about.
BATCH = 4_000_000
#: Per form the sentinels in output order, each with the place of its section in the text.
ORDER = {"psm": ((P, 0), (S, 2), (M, 1)), "spm": ((S, 2), (P, 0), (M, 1)), "plain": ()}

PIECES = pa.schema([("key", pa.binary()), ("at", pa.int64()), ("id", pa.string()), ("form", pa.string()), ("n", pa.int64()),
                    ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("piece", pa.string())])
PIECES_DDL = "key binary, at long, id string, form string, n long, prefix_chars long, middle_chars long, piece string"
RESTORED = pa.schema([("key", pa.binary()), ("section", pa.int32()), ("at", pa.int64()), ("id", pa.string()), ("form", pa.string()),
                      ("n", pa.int64()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("copies", pa.int64()),
                      ("output_sha256", pa.string()), ("piece", pa.string())])
RESTORED_DDL = ("key binary, section int, at long, id string, form string, n long, prefix_chars long, middle_chars long, copies long, "
                "output_sha256 string, piece string")
RESULT = pa.schema([("id", pa.string()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                    ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
RESULT_DDL = "id string, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def plan(id_text: str, text: str, fim_percent: int = 90, spm_percent: int = 20) -> tuple[str, int, int]:
    """Form and the two cuts of a text."""
    h = hashlib.sha256(f"1:{id_text}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in range(0, 32, 8))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in SENTINELS) or h3 % 100 >= fim_percent:
        return "plain", 0, n
    return ("spm" if h4 % 100 < spm_percent else "psm"), a, b


def cut(text: str, form: str, a: int, b: int, chunk: int = CHUNK) -> Iterator[str]:
    """The pieces of the output in order; a sentinel is joined to the first piece after it."""
    bounds = {0: (0, a), 1: (a, b), 2: (b, len(text))}
    for sentinel, section in ORDER[form] or (("", 0),):
        start, end = bounds[section] if form != "plain" else (0, len(text))
        yield sentinel + text[start:min(start + chunk, end)]
        for k in range(start + chunk, end, chunk):
            yield text[k:min(k + chunk, end)]


class _Rows:
    """Rows gathered column by column, handed over as a batch when they hold ``BATCH`` characters."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.held = schema, [], 0

    def add(self, row: tuple, size: int) -> bool:
        self.rows.append(row)
        self.held += size + 100
        return self.held >= BATCH

    def take(self) -> pa.RecordBatch:
        cols = zip(*self.rows) if self.rows else [[] for _ in self.schema]
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, self.schema.types)], schema=self.schema)
        self.rows, self.held = [], 0
        return out


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fim_percent: int = 90, spm_percent: int = 20,
           chunk: int = CHUNK) -> DataFrame:
    """The output of every row as pieces, each row's pieces in one partition and in order.

    ``key`` tells rows apart, ``at`` is the piece's place; ``id`` is the id as text.  Rows that repeat id and text in one
    input partition share a key and repeat its pieces.
    """
    common.ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.spark_partition_id().alias("part"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(PIECES)
        for batch in batches:
            for part in common.blocks(batch, "text"):
                for id_, text, home in zip(*[part.column(n).to_pylist() for n in ("id", "text", "part")]):
                    text = text or ""
                    form, a, b = plan(id_ or "", text, fim_percent, spm_percent)
                    key = hashlib.md5(f"{home}|{id_ is None}|{id_}|".encode())
                    key.update(text.encode())
                    whole = form == "plain"
                    for at, piece in enumerate(cut(text, form, a, b, chunk)):
                        row = (key.digest(), at, id_, form, len(text), None if whole else a, None if whole else b - a, piece)
                        if out.add(row, len(piece)):
                            yield out.take()
        yield out.take()

    return rows.mapInArrow(emit, PIECES_DDL).repartition("key").sortWithinPartitions("key", "at")


def _streams(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """Rows of a sorted partition, a few at a time as Python objects."""
    for batch in batches:
        for part in common.blocks(batch, "piece"):
            yield from zip(*[part.column(n).to_pylist() for n in names])


class _Sections:
    """Takes an output apart at its sentinels as it streams by; a sentinel may stand across two pieces."""

    def __init__(self, form: str):
        self.ahead, self.section, self.rest = list(ORDER[form]), 0, ""

    def feed(self, piece: str) -> Iterator[tuple[int, str]]:
        self.rest += piece
        while self.ahead:
            found = self.rest.find(self.ahead[0][0])
            if found < 0:
                keep = len(self.ahead[0][0]) - 1
                if len(self.rest) > keep:
                    yield self.section, self.rest[:-keep]
                    self.rest = self.rest[-keep:]
                return
            yield self.section, self.rest[:found]
            sentinel, self.section = self.ahead.pop(0)
            self.rest = self.rest[found + len(sentinel):]
        yield self.section, self.rest
        self.rest = ""

    def end(self) -> Iterator[tuple[int, str]]:
        if self.ahead:
            raise ValueError(f"output ends without {self.ahead[0][0]}")
        yield self.section, self.rest


def restored(output: DataFrame) -> DataFrame:
    """From ordered pieces of :func:`pieces`, the pieces of the texts rebuilt from them, in order within their partition.

    A row's last piece (largest ``section``) carries the digest of the output and the number of copies.
    """
    common.ship(output.sparkSession)

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(RESTORED)
        about, at, seen, copies, digest, sections = None, -1, 0, 0, None, None

        def close() -> list[tuple]:
            nonlocal seen
            rows = []
            for section, text in sections.end():
                rows.append((about[0], section, seen, *about[1:], None, None, text))
                seen += 1
            return [*rows, (about[0], 3, 0, *about[1:], copies, digest.hexdigest(), None)]

        for key, place, *rest, piece in _streams(batches, PIECES.names):
            if about is None or key != about[0]:
                if about is not None:
                    for row in close():
                        if out.add(row, len(row[-1] or "")):
                            yield out.take()
                about, at, seen, copies, digest, sections = (key, *rest), -1, 0, 0, hashlib.sha256(), _Sections(rest[1])
            copies += place == 0
            if place == at:  # the same piece of a copy
                continue
            at = place
            digest.update(piece.encode())
            for section, text in sections.feed(piece):
                if text:
                    full = out.add((key, section, seen, *rest, None, None, text), len(text))
                    seen += 1
                    if full:
                        yield out.take()
        if about is not None:
            for row in close():
                out.add(row, len(row[-1] or ""))
        yield out.take()

    return output.mapInArrow(apart, RESTORED_DDL).sortWithinPartitions("key", "section", "at")


def digests(rebuilt: DataFrame) -> DataFrame:
    """Per row: id, n, form, prefix_chars, middle_chars and the digests of output and rebuilt text."""
    common.ship(rebuilt.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest = _Rows(RESULT), hashlib.sha256()
        for key, section, _, id_, form, n, prefix, middle, copies, output, piece in _streams(batches, RESTORED.names):
            if section < 3:
                digest.update(piece.encode())
                continue
            for _ in range(copies):
                if out.add((id_, n, form, prefix, middle, output, digest.hexdigest()), 200):
                    yield out.take()
            digest = hashlib.sha256()
        yield out.take()

    return rebuilt.mapInArrow(run, RESULT_DDL)


def texts(output: DataFrame) -> DataFrame:
    """The transformed text of every row (``id``, ``form``, ``output``) from ordered pieces; a task holds one text at a time."""
    common.ship(output.sparkSession)
    schema = pa.schema([("id", pa.string()), ("form", pa.string()), ("output", pa.string())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, held, at, copies = _Rows(schema), None, [], -1, 0

        def whole() -> Iterator[tuple]:
            text = "".join(held)
            for _ in range(copies):
                yield now[1], now[2], text

        for key, place, id_, form, *_, piece in _streams(batches, PIECES.names):
            if now is None or key != now[0]:
                if now is not None:
                    for row in whole():
                        if out.add(row, len(row[2])):
                            yield out.take()
                now, held, at, copies = (key, id_, form), [], -1, 0
            copies += place == 0
            if place != at:
                held.append(piece)
                at = place
        if now is not None:
            for row in whole():
                if out.add(row, len(row[2])):
                    yield out.take()
        yield out.take()

    return output.mapInArrow(join, "id string, form string, output string")


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fill-in-middle transformation of every document, as digests of the output and of the text rebuilt from it."""
    docs = common.table(spark, sf_dir, "documents")
    kind = docs.schema["doc_id"].dataType
    return digests(restored(pieces(docs))).withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", "doc_id")


#: The contract in DuckDB SQL.
OP11_SQL = """
with h as (
  select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n, sha256('1:' || cast(doc_id as varchar)) as s from documents),
u as (
  select *, cast('0x' || substr(s, 1, 8) as bigint) % (n + 1) as c1, cast('0x' || substr(s, 9, 8) as bigint) % (n + 1) as c2,
    cast('0x' || substr(s, 17, 8) as bigint) % 100 as h3, cast('0x' || substr(s, 25, 8) as bigint) % 100 as h4 from h),
f as (
  select *, least(c1, c2) as a, greatest(c1, c2) as b,
    case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 >= 90 then 'plain'
         when h4 < 20 then 'spm' else 'psm' end as form from u),
p as (
  select *, substr(t, 1, a) as pre, substr(t, a + 1, b - a) as mid, substr(t, b + 1, n - b) as suf from f)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then cast(a as bigint) end as prefix_chars,
  case when form <> 'plain' then cast(b - a as bigint) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
         else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
  sha256(t) as restored_sha256
from p
"""
