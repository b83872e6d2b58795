"""Spelling variants of a corpus's words, by blocked Gram matrices of letter counts.

Words one edit apart differ little in their letter counts: a replaced letter
gives vectors with squared distance 2, an inserted or deleted one distance 1.
So words are put into blocks by length and by how many of their letters fall
into each of ``GROUPS`` groups of letters.  Two words one edit apart lie in one
block or in neighbouring ones: one letter moved to another group, or one letter
more.  For each pair of neighbouring blocks a product of the two count matrices
gives all squared distances; pairs at 1 or 2 are candidates and are compared
letter by letter.

Words are runs of ASCII and Latin-1 letters, lower-cased in A-Z only.

Defined results: null and empty texts have no word; a null id counts as the
empty string in the rule that deletes a letter; repeated rows count each;
an empty table gives an empty result; of near words with equal counts the
smallest in code-point order is the form.

Scale: words are counted by a partial aggregate, so a word in a third of all
rows is a few rows a task.  Blocks are cut by a hash into chunks of about
``CHUNK`` letters, as many as their size asks for, and only neighbouring chunks
meet in a task, so memory does not grow with a block.  Each unordered pair of
blocks meets once.  A word has at most about 180 near words per letter, as the
alphabet has 90 letters, which bounds every later group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm import common

SHORTEST = 7
MIN_COUNT = 2
#: A form is at least this many times as frequent as its variant.
RATIO = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))
GROUPS = 8
#: Letters of a chunk on average, at most.
CHUNK = 16_384
#: Words that one product takes on its right side, about.
RIGHT_WORDS = 4_096
#: Candidate pairs that are compared at once.
COMPARED = 500_000


def runs(text: Column, shortest: int = SHORTEST) -> Column:
    """Maximal runs of letters with at least ``shortest`` code points, A-Z lower-cased; shorter ones can't become words."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit("[a-zÀ-ÿ]{%d,}" % shortest), F.lit(0))


def planted(id_: Column, run: Column, every: int = 31) -> Column:
    """The run without one code point where the crc32 of ``<id>:<run>`` is a multiple of ``every``."""
    h = F.crc32(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), run))
    at = F.pmod(h, F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", delete_every: int | None = None,
          shortest: int = SHORTEST, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and ``n``: words of at least ``shortest`` letters and ``min_count`` occurrences; ``delete_every`` see :func:`planted`."""
    found = docs.select(F.col(id_col).alias("id"), F.explode(runs(F.col(text_col), shortest)).alias("run"))
    word = planted(F.col("id"), F.col("run"), delete_every) if delete_every else F.col("run")
    return (found.select(word.alias("word")).filter(F.length("word") >= shortest)
            .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count))


def letter_groups(word: Column) -> Column:
    """How many letters of the word fall into each group (code point modulo ``GROUPS``)."""
    members = ["".join(c for c in LETTERS if ord(c) % GROUPS == g) for g in range(GROUPS)]
    # a first letter outside the group, mapped to itself, lets translate delete all others
    kept = lambda m: F.translate(word, "0" + m, "0")
    return F.array(*[F.length(word) - F.length(kept(m)) for m in members])


def blocks(counted: DataFrame) -> DataFrame:
    """Chunks of blocks: ``key`` (letters per group), ``chunk``, ``letters`` (the words, all of one length, joined) and ``ns``."""
    keyed = counted.withColumn("groups", letter_groups(F.col("word")))
    large = (keyed.groupBy("groups").agg(F.sum(F.length("word")).alias("size")).filter(F.col("size") > CHUNK)
             .select("groups", F.ceil(F.col("size") / CHUNK).alias("chunks")))
    dealt = keyed.join(large, "groups", "left").withColumn(
        "chunk", F.coalesce(F.pmod(F.xxhash64("word"), "chunks"), F.lit(0)).cast("long"))
    rows = dealt.groupBy("groups", "chunk").agg(F.collect_list(F.struct("word", "n")).alias("w"))
    return rows.select("groups", F.array_join("groups", ".").alias("key"), "chunk",
                       F.array_join("w.word", "").alias("letters"), F.col("w.n").alias("ns"))


def _moves() -> list[list[int]]:
    """What leads from a block to the smaller blocks it meets: nothing, one letter to another group, one letter less."""
    unit = np.eye(GROUPS, dtype=int)
    moved = [unit[h] - unit[g] for g in range(GROUPS) for h in range(GROUPS) if g != h]
    return [m.tolist() for m in [0 * unit[0], *moved, *-unit]]


def meetings(chunks: DataFrame) -> DataFrame:
    """Pairs of neighbouring chunks; the left one's words are as long as the right one's or one letter shorter."""
    size = lambda v: F.aggregate(v, F.lit(0), lambda s, x: s + x)
    moves = F.array(*[F.array(*[F.lit(x) for x in m]) for m in _moves()])
    reached = F.filter(F.transform(moves, lambda m: F.zip_with("groups", m, lambda a, b: a + b)),
                       lambda v: ~F.exists(v, lambda x: x < 0) & ((v <= F.col("groups")) | (size(v) < size(F.col("groups")))))
    right = chunks.select(F.explode(reached).alias("to"), F.col("key").alias("r_key"), F.col("chunk").alias("r_chunk"),
                          F.col("letters").alias("r_letters"), F.col("ns").alias("r_ns")).withColumn("key", F.array_join("to", ".")).drop("to")
    left = chunks.select("key", "chunk", "letters", "ns")
    pairs = left.join(right.hint("merge"), "key").filter((F.col("key") != F.col("r_key")) | (F.col("chunk") <= F.col("r_chunk")))
    own = (F.col("key") == F.col("r_key")) & (F.col("chunk") == F.col("r_chunk"))
    return pairs.select("key", "chunk", "letters", "ns", own.alias("own"), "r_letters", "r_ns")


def _counts(codes: np.ndarray) -> np.ndarray:
    """Letter counts of words given as rows of Latin-1 codes."""
    place = np.where(codes >= 0xC0, codes.astype(np.int64) - (0xC0 - 26), codes.astype(np.int64) - ord("a"))
    flat = (np.arange(len(codes))[:, None] * len(LETTERS) + place).ravel()
    return np.bincount(flat, minlength=len(codes) * len(LETTERS)).reshape(len(codes), -1).astype(np.float32)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """True where the rows of two code matrices of one width, or ``b`` one wider, are one edit apart."""
    width = a.shape[1]
    if b.shape[1] == width:
        return (a != b).sum(1) == 1
    ahead = np.cumprod(a == b[:, :-1], axis=1).sum(1)
    behind = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return ahead + behind >= width


def near_pairs(a: np.ndarray, b: np.ndarray, own: range = range(0)) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` one edit apart; rows ``own`` of ``b`` are ``a`` itself, whose pairs count once."""
    ca, cb = _counts(a), _counts(b)
    apart = ca @ cb.T
    apart *= -2
    apart += (ca * ca).sum(1)[:, None]
    apart += (cb * cb).sum(1)[None, :]
    i, j = np.nonzero((apart < 2.5) & (apart > 0.5))
    if len(own):
        once = (j < own.start) | (j >= own.stop) | (j - own.start > i)
        i, j = i[once], j[once]
    good = [np.zeros(0, bool)] + [_one_edit(a[i[k:k + COMPARED]], b[j[k:k + COMPARED]]) for k in range(0, len(i), COMPARED)]
    good = np.concatenate(good)
    return i[good], j[good]


def _strings(codes: np.ndarray) -> list[str]:
    text, width = codes.tobytes().decode("latin-1"), codes.shape[1]
    return [text[k:k + width] for k in range(0, len(text), width)]


def _multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words, both ways, of rows of :func:`meetings` in which a left chunk's rows follow each other."""
    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])

    def matrix(letters: str, rows: int) -> np.ndarray:
        return np.frombuffer(letters.encode("latin-1"), np.uint8).reshape(rows, -1)

    def done(left: tuple, rights: list) -> Iterator[pa.RecordBatch]:
        a, na = left
        for width in (a.shape[1], a.shape[1] + 1):
            mine = [r for r in rights if r[0].shape[1] == width]
            if not mine:
                continue
            b, nb = np.concatenate([r[0] for r in mine]), np.concatenate([r[1] for r in mine])
            starts = np.cumsum([0] + [len(r[0]) for r in mine])
            own = next((range(s, s + len(r[0])) for s, r in zip(starts, mine) if r[2]), range(0))
            i, j = near_pairs(a, b, own)
            for k in range(0, len(i), COMPARED):
                x, y = i[k:k + COMPARED], j[k:k + COMPARED]
                first, second = _strings(a[x]), _strings(b[y])
                yield pa.RecordBatch.from_arrays([pa.array(first + second, pa.string()), pa.array(second + first, pa.string()),
                                                  pa.array(np.concatenate([nb[y], na[x]]))], schema=schema)

    at, left, rights, held = None, None, [], 0
    for batch in batches:
        cols = [batch.column(n) for n in batch.schema.names]
        for row in range(batch.num_rows):
            key = (cols[0][row].as_py(), cols[1][row].as_py())
            if rights and (key != at or held >= RIGHT_WORDS):
                yield from done(left, rights)
                rights, held = [], 0
            if key != at:
                ns = cols[3][row].values.to_numpy()
                at, left = key, (matrix(cols[2][row].as_py(), len(ns)), ns)
            ns = cols[6][row].values.to_numpy()
            rights.append((matrix(cols[5][row].as_py(), len(ns)), ns, cols[4][row].as_py()))
            held += len(ns)
    if rights:
        yield from done(left, rights)


def near_words(counted: DataFrame) -> DataFrame:
    """``word``, ``near``, ``near_n``: every ordered pair of words one edit apart, of a table ``word``, ``n`` without repeats."""
    common.ship(counted.sparkSession)
    chunks = common.shared(blocks(counted))
    return meetings(chunks).mapInArrow(_multiply, "word string, near string, near_n long")


def variants(counted: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Every word with ``form``, ``root``, ``n``, ``n_near`` and ``form_n``.

    The form is the near word of largest count (ties: smallest) if it is at
    least ``ratio`` times as frequent; the root is where the forms lead.
    """
    counted = common.shared(counted)
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("near")))
    near = near_words(counted).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    judged = counted.join(near, "word", "left")
    takes = -F.col("best.rank") >= ratio * F.col("n")
    judged = common.shared(judged.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                         F.when(takes, F.col("best.near")).alias("form"),
                                         F.when(takes, -F.col("best.rank")).cast("long").alias("form_n")))
    roots = common.shared(judged.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    # each round doubles the steps taken; counts grow by the ratio at each step, so few rounds do
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        further = common.shared(roots.join(ahead, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"),
                                                                         F.col("beyond").isNotNull().alias("moved")))
        roots = further.select("word", "root")
        if further.filter("moved").isEmpty():
            break
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents, with a planted deletion in about one of 31 runs."""
    return variants(words(common.table(spark, sf_dir, "documents"), delete_every=31))
