"""Commits of a stream's micro-batches: what makes several tables one atomic sink.

A micro-batch writes its rows to every table with two bookkeeping columns, the
stream's id and the batch's number, and then commits.  A commit is one small
file; readers see a row only if its batch is committed, so a crash between two
tables' writes shows nothing, and the replay of the batch completes it.  A
stream's batches run one after another, so its last committed number stands for
all before it and a stream needs one file, however long it runs.

A commit also carries the stream's running totals, counted from the rows that
its batches really added to the tables: live counters that a replay or a
restart can't count twice.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.sources import storage

QUERY, BATCH = "_query", "_batch"


def stream_id(spark: SparkSession) -> str:
    """The id of the stream whose ``foreachBatch`` function runs (it is the checkpoint's: a restart keeps it)."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


class Commits:
    """The commits under one folder of shared storage."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _numbers(self, query: str, kind: str) -> list[int]:
        found = storage.names(self.spark, f"{self.path}/{QUERY}={query}")
        return sorted(int(n[len(kind) + 1:-5]) for n in found if n.startswith(f"{kind}-") and n.endswith(".json"))

    def _file(self, query: str, kind: str, batch: int) -> str:
        return f"{self.path}/{QUERY}={query}/{kind}-{batch:+013d}.json"

    def _write(self, query: str, kind: str, batch: int, record: dict) -> None:
        storage.write_json(self.spark, self._file(query, kind, batch), record)

    def last(self, query: str) -> dict:
        """The stream's last commit: ``batch`` (-1 before the first) and its running totals."""
        done = self._numbers(query, "commit")
        return json.loads(storage.read_text(self.spark, self._file(query, "commit", done[-1]))) if done else {"batch": -1}

    def begin(self, query: str, batch: int) -> str:
        """Start a batch: ``done`` if it is committed already, ``again`` if an earlier try may have left rows, else ``new``."""
        if self.last(query)["batch"] >= batch:
            return "done"
        again = batch in self._numbers(query, "begin")
        if not again:
            self._write(query, "begin", batch, {"batch": batch})
        return "again" if again else "new"

    def commit(self, query: str, batch: int, counts: dict[str, int]) -> None:
        """Make a batch visible and add its counts to the running totals."""
        before = self.last(query)
        sums = {k: v for k, v in before.items() if k not in ("batch", "before")}
        totals = sums | {k: sums.get(k, 0) + n for k, n in counts.items()}
        self._write(query, "commit", batch, {"batch": batch, **totals, "before": sums})
        # only now is what came before not needed
        for kind in ("begin", "commit"):
            for old in self._numbers(query, kind):
                if old < batch or kind == "begin":
                    storage.delete(self.spark, self._file(query, kind, old))

    def revoke(self, query: str, batch: int) -> None:
        """Take a stream's last commit back, as if its batch had been lost just before it (tests and repairs).

        The batch's rows become invisible until it is committed again.
        """
        last = self.last(query)
        if last["batch"] != batch:
            raise ValueError(f"batch {batch} is not the last commit")
        self._write(query, "begin", batch, {"batch": batch})
        self._write(query, "commit", batch - 1, {"batch": batch - 1, **last.get("before", {})})
        storage.delete(self.spark, self._file(query, "commit", batch))

    def streams(self) -> list[str]:
        prefix = f"{QUERY}="
        return [n[len(prefix):] for n in storage.names(self.spark, self.path) if n.startswith(prefix)]

    def totals(self, fields: list[str]) -> DataFrame:
        """One row per stream: ``_query``, ``batch`` and the running totals of ``fields``."""
        schema = T.StructType([T.StructField("batch", T.LongType()), *[T.StructField(f, T.LongType()) for f in fields], T.StructField(QUERY, T.StringType())])
        if not storage.exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("pathGlobFilter", "commit-*.json").json(self.path)

    def visible(self, table: DataFrame) -> DataFrame:
        """The table's rows of committed batches, without the bookkeeping columns; rows that no stream wrote are visible."""
        done = self.totals([]).groupBy(F.col(QUERY).alias("_stream")).agg(F.max("batch").alias("_done"))
        seen = table.join(done, table[QUERY] == done["_stream"], "left")
        return seen.where(F.col(QUERY).isNull() | (F.col(BATCH) <= F.col("_done"))).select(
            *[c for c in table.columns if c not in (QUERY, BATCH)])


def marked(rows: DataFrame, query: str, batch: int) -> DataFrame:
    """``rows`` with the bookkeeping columns."""
    return rows.withColumn(QUERY, F.lit(query)).withColumn(BATCH, F.lit(batch).cast("long"))


def watermarks(spark: SparkSession, checkpoint: str, batch: int) -> int:
    """The watermark (ms since the epoch) by which Spark drops late rows in a batch: that of the batch before.

    It is in the checkpoint's record of offsets, which is written before a batch runs and stays for its replay.
    """
    if batch <= 0:
        return 0
    lines = storage.read_text(spark, f"{checkpoint.rstrip('/')}/offsets/{batch - 1}").splitlines()
    return int(json.loads(lines[1])["batchWatermarkMs"])
