"""Helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.session import ensure_checkpoint_dir

#: Bytes of text that a worker turns into Python objects at once.
BLOCK_BYTES = 4_000_000

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared(df: DataFrame) -> DataFrame:
    """``df`` written once to the folder of ``spark.checkpoint.dir`` and read from there.

    Used for results that several later steps read.  The files are on shared
    storage, so a lost executor costs no recomputation.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share (``spark.checkpoint.dir``)."""
    return ensure_checkpoint_dir(spark)


def ship(spark: SparkSession) -> None:
    """Let Python workers on this host import the package from its folder.

    A cluster gets the package by ``--py-files``; a path that a host does not
    have is ignored there.
    """
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([p for p in [PACKAGE_ROOT, *paths] if p])


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names, in any letter case."""
    taken = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in taken])


def quoted(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def held_out(id_col: str = "doc_id") -> Column:
    """True for rows that no model learns from: crc32 of the id as text has remainder 1 by 3; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def annotate(docs: DataFrame, text_col: str, make: Callable[[], Callable[[pa.Array], dict[str, pa.Array]]],
             fields: list[T.StructField], keep: str | None = None) -> DataFrame:
    """``docs`` with the columns that a function of the text column yields.

    ``make()`` runs once per task and returns the function from an Arrow string
    array to one array per new field.  Input columns with the name of a new
    field are replaced.  ``keep`` names a boolean new field: rows where it is
    not true are dropped in the task.  Nothing is shuffled.
    """
    ship(docs.sparkSession)
    docs = without(docs, *[f.name for f in fields])
    schema = T.StructType(list(docs.schema.fields) + fields)
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if not batch.num_rows:
                continue
            for part in blocks(batch, text_col):
                new = work(part.column(text_col))
                out = pa.RecordBatch.from_arrays([*part.columns, *[new[n] for n in names]], [*part.schema.names, *names])
                yield out.filter(new[keep]) if keep else out

    return docs.mapInArrow(run, schema)


def blocks(batch: pa.RecordBatch, text_col: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``most`` bytes of text, or of one row: what a worker holds as Python objects."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(size, most + (size[at - 1] if at else 0), "right")))
        yield batch.slice(at, to - at)
        at = to


def file_bytes(path: str) -> bytes:
    """A small file that the driver has, such as a vocabulary."""
    with open(path, "rb") as f:
        return f.read()
