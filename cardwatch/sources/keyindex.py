"""Key filters beside a table's files: which files may hold any of a batch's keys.

Every data file has a blocked Bloom filter of its keys: a key falls into one
block of 256 bits and sets two bits in each of the block's four words.  The
filters are built by an aggregation (``bit_or`` per file and block) and stored
as Parquet in the table's ``_keys`` folder, which readers of the table skip.  A
batch's keys, looked up in the filters, pick the files that an anti-join has to
read; all others certainly hold none of them, so a key stays unique in the whole
table while a batch of new keys reads about no file, however keys are ordered.

At ``BITS`` bits a key a new key matches a file's filter about once in 170,000
times; a false match costs a read, never a result.  Filters take about 5 bytes
a key where the keys themselves take 36.  A ``pending`` file is written before
the table and deleted after its filters: where one is found, files without a
filter are looked for and indexed first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.sources import storage

FOLDER, PENDING = "_keys", "_keys_pending"
BITS = 32
#: Blocks of a file's filter, as a power of two, at most.
MOST = 24
SCHEMA = "file string, power int, block long, w0 long, w1 long, w2 long, w3 long"


def _block(key: Column, power: Column) -> Column:
    return F.when(power == 0, F.lit(0)).otherwise(F.call_function("shiftrightunsigned", F.xxhash64(key), 64 - power)).cast("long")


def _word(key: Column, lane: int) -> Column:
    """The key's two bits in one word of its block, from a second hash."""
    second = F.xxhash64(key, F.lit("bits"))
    bit = lambda shift: F.call_function("shiftrightunsigned", second, F.lit(shift)).bitwiseAND(F.lit(63).cast("long")).cast("int")
    one = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), at)
    return one(bit(12 * lane)).bitwiseOR(one(bit(12 * lane + 6)))


def _words(key: Column) -> list[Column]:
    return [_word(key, lane).alias(f"w{lane}") for lane in range(4)]


def filters(keys: DataFrame, key: str, file: str) -> DataFrame:
    """Filter rows of a table of keys with the file of each."""
    rows = keys.where(F.col(key).isNotNull()).select(F.col(file).alias("file"), F.col(key).alias("key"))
    blocks = F.ceil(F.log2(F.greatest(F.col("n") * F.lit(BITS / 256.0), F.lit(1.0))))
    sizes = rows.groupBy("file").agg(F.count("*").alias("n")).select("file", F.least(blocks, F.lit(MOST)).cast("int").alias("power"))
    placed = rows.join(sizes, "file").select("file", "power", _block(F.col("key"), F.col("power")).alias("block"), *_words(F.col("key")))
    return placed.groupBy("file", "power", "block").agg(*[F.bit_or(f"w{k}").alias(f"w{k}") for k in range(4)])


def hits(index: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows of the filters that a key of the batch matches."""
    keys = batch.where(F.col(key).isNotNull()).select(F.col(key).alias("key")).distinct()
    powers = F.broadcast(index.select(F.col("power").alias("p_power")).distinct())  # at most MOST + 1 rows
    probes = keys.crossJoin(powers)
    probes = probes.select("p_power", _block(F.col("key"), F.col("p_power")).alias("p_block"), *[c.alias(f"p{k}") for k, c in enumerate(_words(F.col("key")))])
    hit = (index["power"] == probes["p_power"]) & (index["block"] == probes["p_block"])
    for k in range(4):
        hit = hit & (F.col(f"w{k}").bitwiseAND(F.col(f"p{k}")) == F.col(f"p{k}"))
    # never broadcast: estimates miss that there is a row per key and power
    return index.join(probes.hint("merge"), hit, "left_semi")


def candidates(spark: SparkSession, path: str, batch: DataFrame, key: str) -> list[str]:
    """Files of the table that may hold a key of the batch (a list of paths, at most as many as the table has files)."""
    if not storage.exists(spark, f"{path}/{FOLDER}"):
        return []
    index = spark.read.schema(SCHEMA).parquet(f"{path}/{FOLDER}")
    return [r["file"] for r in hits(index, batch, key).select("file").distinct().collect()]


def add(spark: SparkSession, path: str, files: set[str], key: str, fmt: str = "parquet") -> None:
    """Index files of the table."""
    if files:
        keys = spark.read.format(fmt).load(sorted(files)).select(key, F.col("_metadata.file_path").alias("_file"))
        filters(keys, key, "_file").write.mode("append").parquet(f"{path}/{FOLDER}")


def _folders(spark: SparkSession, path: str, levels: int) -> list[str]:
    if not levels:
        return [path]
    return [f for n in storage.names(spark, path) if "=" in n for f in _folders(spark, f"{path}/{n}", levels - 1)]


def listed(spark: SparkSession, path: str, partition_by: list[str] | None, folders: list[str] | None = None) -> set[str]:
    """Data files of the table, of all its partitions or of the given ones."""
    found = folders if folders is not None else _folders(spark, path, len(partition_by or []))
    return set().union(*[storage.data_files(spark, f) for f in found]) if found else set()


def repair(spark: SparkSession, path: str, key: str, partition_by: list[str] | None, fmt: str = "parquet") -> None:
    """After a crash between a write and its filters, or for a table without any: index all files without a filter."""
    pending = storage.names(spark, f"{path}/{PENDING}")
    has = storage.exists(spark, f"{path}/{FOLDER}")
    if has and not pending:
        return
    every = listed(spark, path, partition_by)
    known = {r["file"] for r in spark.read.schema(SCHEMA).parquet(f"{path}/{FOLDER}").select("file").distinct().collect()} if has else set()
    add(spark, path, every - known, key, fmt)
    for name in pending:
        storage.delete(spark, f"{path}/{PENDING}/{name}")


def begin(spark: SparkSession, path: str) -> str:
    """Note that a write is under way; returns the note's path."""
    note = f"{path}/{PENDING}/{uuid.uuid4().hex}.json"
    storage.write_json(spark, note, {})
    return note
