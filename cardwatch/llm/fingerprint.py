"""Document fingerprints as invertible Bloom lookup sketches.

A text is cut into paragraphs: at line and sentence ends, alike everywhere in
the text, and only a sentence of more than ``LONGEST`` characters in pieces.
The set of their 64-bit digests goes into a sketch of three tables of cells, each
with a count, the XOR of the digests and the XOR of their check values.  The
fingerprint is the sketch with ``CELLS`` cells a table.

To compare two texts, their sketches with tables for the two sets' sizes are
subtracted, and peeling takes cells with a single digest until all differing
digests are recovered.  A row that is not recovered after ``STEPS`` steps is
retried with another salt and tables of twice the size, until it succeeds.  The
likeness of two texts is the share of common digests among all, from the two
sizes and the recovered difference.

Defined results: null counts like the empty text, which has no paragraph; two
texts without paragraphs have likeness 1, one without and one with have 0.
Rows with one id follow each other in the order of their texts; a null id comes
after all others, and if all ids are null the last row's next text is empty.

Scale: texts are shuffled once, into ranges of ids that quantiles bound; the
row that continues a range is copied into it, so no global order is needed.
Sketches that are compared are rows, one for each cell in use, keyed by range
and row: adding up a cell with opposite signs for the two texts subtracts them,
and a step of peeling is an ``explode`` and another sum.  All of it stays in the
partitions of that one shuffle, with work linear in the number of paragraphs.

Built-in functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwatch.llm import common
from cardwatch.llm.spans import let

TABLES, CELLS = 3, 8
#: A sentence longer than this is cut in pieces, counted from its own start.
LONGEST = 300
#: Cells of a compared table for each digest of the two sets (rounded up to a power of two).
SPACE = 2
#: Steps of peeling in one attempt, each of one table.
STEPS = 6
#: Ranges of ids at most, found in two steps of 100.
RANGES = 10_000
#: Bytes of text for a task; up to ``RANGES`` tasks.
BYTES_PER_TASK = 8_000_000
#: Ends of sentences and lines; blanks after an end belong to it, so the next paragraph is the same at a text's start.
ENDS = r".!?。！？\n"
#: No end.  Wide characters apart, as a class of both kinds takes seven times as long.
INSIDE = r"(?:[^.!?\nĀ-￿]|(?![%s])[Ā-￿])" % ENDS
PARAGRAPH = r"%s{1,%d}+(?:[%s][%s \t\r]*)?|[%s][%s \t\r]*" % (INSIDE, LONGEST, ENDS, ENDS, ENDS, ENDS)


def digests(text: Column) -> Column:
    """The set of paragraph digests of a text."""
    parts = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), F.lit(0))
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(-1)).bitwiseAND(F.lit(0xFFFFFFFF))


def _place(key: Column, table: int, mask: Column, salt: int = 0) -> Column:
    return F.xxhash64(key, F.lit(salt * TABLES + table)).bitwiseAND(mask)


def sketch(keys: Column) -> Column:
    """The fingerprint of a set of digests: per cell count, XOR of digests and XOR of check values in hexadecimal."""
    zero = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("n", "key", "check")])

    def entry(key: Column) -> Column:
        places = [_place(key, t, F.lit(CELLS - 1)).alias(f"place{t}") for t in range(TABLES)]
        return F.struct(key.alias("key"), _check(key).alias("check"), *places)

    def add(cell: Column, e: Column) -> Column:
        return F.struct((cell["n"] + 1).alias("n"), cell["key"].bitwiseXOR(e["key"]).alias("key"),
                        cell["check"].bitwiseXOR(e["check"]).alias("check"))

    def text(cell: Column) -> Column:
        return F.concat(*[F.lpad(F.hex(cell[c]), width, "0") for c, width in (("n", 8), ("key", 16), ("check", 8))])

    def cell(entries: Column, table: int, place: int) -> Column:
        return F.aggregate(F.filter(entries, lambda e: e[f"place{table}"] == place), zero, add, text)

    cells = let(F.transform(keys, entry), lambda e: F.concat(*[cell(e, t, p) for t in range(TABLES) for p in range(CELLS)]))
    return F.lower(cells)


# A compared cell's number holds the exponent of its table's size, the table and the place; these three are no cells.
_SIZE_AT, _TABLE_AT = 56, 54
_ROW, _PLUS, _MINUS = -1, -2, -3


def _cell(key: Column, exponent: Column, table: int, salt: int) -> Column:
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), exponent) - 1
    return F.shiftleft(exponent.cast("long"), _SIZE_AT) + F.lit(table << _TABLE_AT) + _place(key, table, mask, salt)


def _entry(cell: Column | int, n: Column | int, key: Column | int, check: Column | int) -> Column:
    values = {"cell": cell, "n": n, "key": key, "check": check}
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).cast("long").alias(c) for c, v in values.items()])


def _added(rows: DataFrame) -> DataFrame:
    """Cells added up, without those that come to nothing."""
    sums = rows.groupBy("part", "pair", "cell", "payload").agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("check").alias("check"))
    return sums.filter("cell < 0 or n != 0 or key != 0 or check != 0")


def subtracted(rows: DataFrame, others: list[str], space: float, salt: int) -> DataFrame:
    """The cells of the sketch of ``keys`` minus the sketch of each column of ``others``, and each row itself as a payload."""
    first = F.struct(*[F.col(c) for c in rows.columns])
    number = lambda i: F.col("k") * len(others) + i
    side = lambda i, n, exponent, keys, payload=None: F.struct(
        number(i).alias("pair"), F.lit(n).cast("long").alias("n"), exponent.cast("int").alias("exponent"), keys.alias("keys"),
        (first if payload else F.lit(None).cast(rows.select(first.alias("x")).schema["x"].dataType)).alias("payload"))
    sides = [side(0, 0, F.lit(0), F.array(F.lit(0).cast("long")), payload=True)]
    for i, other in enumerate(others):
        cells = F.greatest(F.lit(float(CELLS)), (F.size("keys") + F.size(other)) * F.lit(float(space)))
        exponent = F.ceil(F.log2(cells))
        sides += [side(i, 1, exponent, F.col("keys")), side(i, -1, exponent, F.col(other))]
    digest = (rows.select("part", F.explode(F.array(*sides)).alias("s")).select("part", "s.*")
              .select("part", "pair", "n", "exponent", "payload", F.explode("keys").alias("key")))
    cells = F.array(*[_entry(_cell(F.col("key"), F.col("exponent"), t, salt), F.col("n"), F.col("key"), _check(F.col("key")))
                      for t in range(TABLES)])
    entries = F.when(F.col("payload").isNotNull(), F.array(_entry(_ROW, 0, 0, 0))).otherwise(cells)
    return _added(digest.select("part", "pair", "payload", F.explode(entries).alias("e")).select("part", "pair", "payload", "e.*"))


def peeled(cells: DataFrame, table: int, salt: int) -> DataFrame:
    """One step of peeling: the digests that are alone in a cell of this table leave all tables and are counted by their sign.

    A digest is in one cell of a table, so none is taken twice.
    """
    key, n, at = F.col("key"), F.col("n"), F.col("cell")
    exponent = F.shiftright(at, _SIZE_AT).cast("int")
    single = ((at >= 0) & (F.abs(n) == 1) & (F.shiftright(at, _TABLE_AT).bitwiseAND(F.lit(3)) == table)
              & (F.col("check") == _check(key)) & (at == _cell(key, exponent, table, salt)))
    gone = [_entry(_cell(key, exponent, t, salt), -n, key, F.col("check")) for t in range(TABLES) if t != table]
    taken = F.array(_entry(F.when(n == 1, _PLUS).otherwise(_MINUS), 1, 0, 0), *gone)
    entries = F.when(single, taken).otherwise(F.array(_entry(at, n, key, F.col("check"))))
    return _added(cells.select("part", "pair", "payload", F.explode(entries).alias("e")).select("part", "pair", "payload", "e.*"))


def recovered(rows: DataFrame, others: list[str], space: float, salt: int) -> DataFrame:
    """One attempt: ``rows`` with ``plus_`` and ``minus_`` of each column of ``others``, how many digests only ``keys`` and
    only that column has, and ``left``, the cells that peeling did not clear (0 if all was recovered)."""
    cells = subtracted(rows, others, space, salt)
    for step in range(STEPS):
        cells = peeled(cells, step % TABLES, salt)
    row = Window.partitionBy("part", "k")
    total = lambda condition, value: F.coalesce(F.sum(F.when(condition, value)).over(row), F.lit(0).cast("long"))
    names = {"left": total(F.col("cell") >= 0, 1)}
    for i, other in enumerate(others):
        mine = F.pmod("pair", F.lit(len(others))) == i
        names[f"plus_{other}"] = total(mine & (F.col("cell") == _PLUS), F.col("n"))
        names[f"minus_{other}"] = total(mine & (F.col("cell") == _MINUS), F.col("n"))
    cells = cells.withColumn("k", F.floor(F.col("pair") / len(others)))
    return cells.withColumns(names).filter("payload is not null").select("payload.*", *names)


def differences(rows: DataFrame, others: list[str], space: float = SPACE) -> DataFrame:
    """``rows`` (numbered by ``k`` within ``part``) with the sizes of the differences between ``keys`` and each column of
    ``others``, all recovered by peeling; ``retries`` says how many larger attempts a row took."""
    whole, tries = [], 0
    left = rows
    while True:
        tried = common.shared(recovered(left, others, space * 2 ** tries, tries + 1)).withColumn("retries", F.lit(tries))
        whole.append(tried.filter("left = 0").drop("left"))
        left = tried.filter("left > 0").select(*rows.columns)
        if left.isEmpty():
            return reduce(DataFrame.unionByName, whole)
        tries += 1


def likeness(size_a: Column, plus: Column, minus: Column) -> Column:
    """Common digests among all."""
    every = size_a + minus
    return F.when(every == 0, 1.0).otherwise((size_a - plus) / every.cast("double"))


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many bounds are below the value, found in two steps."""
    step = 100 if len(bounds) > 100 else max(len(bounds), 1)
    rows = [bounds[k:k + step] for k in range(0, len(bounds), step)]
    below = lambda array: F.size(F.filter(array, lambda b: b < value))
    if len(rows) <= 1:
        return below(F.array(*[F.lit(b) for b in bounds]).cast("array<long>")) if bounds else F.lit(0)
    lasts = F.array(*[F.lit(r[-1]) for r in rows])
    table = F.array(*[F.array(*[F.lit(b) for b in r]) for r in rows])
    return let(below(lasts), lambda k: F.least(k * step + F.coalesce(below(F.get(table, k)), F.lit(0)), F.lit(len(bounds))))


def successors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``text``, ``keys`` (digests) of every row and ``next_text``, ``next_keys`` of the row that follows by descending id.

    The smallest id is followed by the largest.  Rows are numbered by ``k`` within ``part``.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    tasks = min(RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BYTES_PER_TASK))
    ranges = min(RANGES, 8 * tasks)
    cuts = F.array(*[F.lit((k + 1) / ranges) for k in range(ranges)])
    bounds = rows.agg(F.percentile_approx("id", cuts, 20 * ranges).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))
    home = F.when(F.col("id").isNull(), 0).otherwise(_range_of(F.col("id"), bounds)).cast("int")
    rows = rows.withColumn("home", home)
    # a bound is the largest id of its range: its row also continues the range above, and the largest of all the lowest
    tops = F.col("id").isNotNull() & (F.col("id") == F.get(F.array(*[F.lit(b) for b in bounds]).cast("array<long>"), F.col("home")))
    own = F.struct(F.col("home").alias("part"), F.lit(0).alias("guest"))
    above = F.struct((F.col("home") + 1).alias("part"), F.lit(1).alias("guest"))
    lowest = F.struct(F.lit(0).alias("part"), F.lit(2).alias("guest"))
    places = F.when(tops & (F.col("home") == len(bounds) - 1), F.array(own, lowest)).when(tops, F.array(own, above)).otherwise(F.array(own))
    dealt = rows.select("id", "text", F.explode(places).alias("p")).select("id", "text", F.col("p.part").alias("part"), F.col("p.guest").alias("guest"))
    near = dealt.repartition(tasks, "part").withColumn("keys", digests(F.col("text")))
    order = Window.partitionBy("part").orderBy("guest", F.desc_nulls_last("id"), "text")
    ahead = [F.lead(c).over(order).alias(name) for c, name in (("text", "next_text"), ("keys", "next_keys"))]
    none = F.array().cast("array<long>")
    number = F.row_number().over(order).cast("long").alias("k")
    return (near.select("part", number, "id", "text", "keys", "guest", *ahead).filter("guest = 0").drop("guest")
            .withColumns({"next_text": F.coalesce("next_text", F.lit("")), "next_keys": F.coalesce("next_keys", none)}))


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every row's text and of its edited text (the last third replaced by the next row's beginning),
    and the likeness of the text to the edited text and to the next row's."""
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    rows = successors(docs, id_col, text_col).withColumn(
        "edited", F.concat(F.left("text", n - third), F.left("next_text", third)))
    rows = rows.select("part", "k", "id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       "keys", digests(F.col("edited")).alias("edited"), "next_keys")
    size = F.size("keys")
    return differences(rows.withColumnRenamed("next_keys", "after"), ["edited", "after"]).select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256",
        sketch(F.col("keys")).alias("fingerprint"), sketch(F.col("edited")).alias("edited_fingerprint"),
        likeness(size, F.col("plus_edited"), F.col("minus_edited")).alias("near_edited"),
        likeness(size, F.col("plus_after"), F.col("minus_after")).alias("near_next"))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, and how like their edited text and the next document they are."""
    return compare(common.table(spark, sf_dir, "documents"))
