"""Trailing counts of a stream: keyed list state with event-time timers.

The streaming form of ``velocity.trailing``: for every transaction the number of
the user's transactions in the range that ends with it, as the SQL frame
``RANGE BETWEEN range PRECEDING AND CURRENT ROW`` counts them.

A transaction's count is final once the watermark has passed its time.  Its
key's state is a list of (time, id): rows whose count is still open, and rows
that later ones may still count.  A timer at the earliest open time emits what
has become final, drops what no later row can reach, and sets the next timer;
after the last one the list is empty and is cleared.

Keys are (user, bucket of time).  A row is also sent to the next bucket if its
range reaches there, where it is counted but not emitted, so a hot user's
history is spread over many keys and tasks.  Every key costs some calls between
Python and the JVM per batch, so for large batches (replays, back-fills)
``shards`` puts many users under one key: the calls are then as many however many
users there are, and a key's rows are counted at once, each user's apart.  State
needs the RocksDB store (``jobs.start(rocksdb=True)``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from cardwatch import schema as S
from cardwatch.functions import interval_micros
from cardwatch.streaming.jobs import as_wall_clock

#: One element of a key's list: some rows (``HELD``) as an Arrow stream.
STATE = T.StructType([T.StructField("rows", T.BinaryType())])
HELD = pa.schema([("user_id", pa.string()), ("transaction_id", pa.string()), ("us", pa.int64()), ("own", pa.bool_())])
OUTPUT = "transaction_id string, user_id string, us long, count long"


def pack(rows: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, HELD) as writer:
        writer.write_table(pa.Table.from_pandas(rows, HELD, preserve_index=False))
    return sink.getvalue().to_pybytes()


def unpack(elements: Iterator[tuple]) -> pd.DataFrame:
    return pa.concat_tables([pa.ipc.open_stream(e[0]).read_all() for e in elements]).to_pandas()


def counts_of(user: np.ndarray, us: np.ndarray, ready: np.ndarray, lower: int) -> np.ndarray:
    """For each ready row the number of its user's rows from ``lower`` before it up to its time; users are numbered from 0."""
    out = np.zeros(int(ready.sum()), np.int64)
    at = us - us.min() + lower
    span = int(at.max()) + 1
    step = max(1, 2**62 // span)  # users whose places fit into 64 bits at once
    for first in range(0, int(user.max()) + 1, step):
        here = (user >= first) & (user < first + step)
        place = (user[here] - first) * span + at[here]
        order = np.sort(place)
        asked = place[ready[here]]
        out[here[ready]] = np.searchsorted(order, asked, "right") - np.searchsorted(order, asked - lower, "left")
    return out


class TrailingCount(StatefulProcessor):
    """Counts of one key's rows; ``lower`` is how far (in microseconds, inclusive) a row's range reaches back."""

    def __init__(self, lower: int):
        self.lower = lower

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", STATE)

    def _set_timer(self, us: np.ndarray, own: np.ndarray, now: int) -> None:
        """The next timer (ms): the earliest open row, or else when the last row is out of every later row's reach."""
        at = int(us[own].min()) if own.any() else int(us.max()) + self.lower
        at = max(at // 1000 + 1, now + 1)
        set_already = [t for t in self.handle.listTimers() if t > now]  # not the one that expires now
        if not set_already or min(set_already) > at:
            for t in set_already:
                self.handle.deleteTimer(t)
            self.handle.registerTimer(at)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(rows))[HELD.names]
        self.rows.appendValue((pack(came),))
        self._set_timer(came["us"].to_numpy(), came["own"].to_numpy(), timerValues.getCurrentWatermarkInMs())
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        held = unpack(self.rows.get())
        us, own = held["us"].to_numpy(), held["own"].to_numpy()
        ready = own & (us <= watermark)
        if ready.any():
            user, _ = pd.factorize(held["user_id"], use_na_sentinel=False)
            yield held.loc[ready, ["transaction_id", "user_id", "us"]].assign(count=counts_of(user, us, ready, self.lower))
        open_ = own & ~ready
        # later rows are after the watermark, so what ended before their range is not needed
        stay = open_ | (us >= watermark - self.lower)
        if not stay.any():
            self.rows.clear()
            return
        self.rows.put([(pack(held.assign(own=open_)[stay]),)])
        self._set_timer(us[stay], open_[stay], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def trailing(txn: DataFrame, range_: str = S.VELOCITY_WINDOW, threshold: int = S.VELOCITY_MAX_TRANSACTIONS, lower_inclusive: bool = True,
             bucket: str = "1 hour", count_col: str = "trailing_count", flag_col: str = "trailing_fraud", shards: int | None = None) -> DataFrame:
    """(transaction_id, user_id, event_time, count, flag) of a watermarked stream; late rows are not counted.

    ``lower_inclusive=False`` makes the range half-open, ``(t - range, t]``.  Rows with equal time count each other.
    ``bucket`` is the span of time that one key holds, at least the range.  With
    ``shards`` a key holds the users of one of so many parts of all users, else one user.
    """
    span, size = interval_micros(range_), interval_micros(bucket)
    if size < span:
        raise ValueError("a bucket must hold a whole range")
    lower = span if lower_inclusive else span - 1
    us = F.unix_micros("event_time")
    here, beyond = F.floor(us / F.lit(size)), F.floor((us + F.lit(lower)) / F.lit(size))
    entry = lambda b, own: F.struct(b.alias("bucket"), F.lit(own).alias("own"))
    places = F.when(beyond > here, F.array(entry(here, True), entry(beyond, False))).otherwise(F.array(entry(here, True)))
    rows = txn.select("user_id", "transaction_id", "event_time", us.alias("us"), F.explode(places).alias("p"))
    rows = rows.select("user_id", F.col("p.bucket").alias("bucket"), "transaction_id", "event_time", "us", F.col("p.own").alias("own"))
    who = "user_id"
    if shards:
        who, rows = "shard", rows.withColumn("shard", F.pmod(F.xxhash64("user_id"), F.lit(int(shards))))
    counted = rows.groupBy(who, "bucket").transformWithStateInPandas(
        TrailingCount(lower), outputStructType=OUTPUT, outputMode="append", timeMode="eventTime")
    return counted.select("transaction_id", "user_id", as_wall_clock(F.timestamp_micros("us")).alias("event_time"),
                          F.col("count").alias(count_col), (F.col("count") > threshold).alias(flag_col))


def rapid_use(txn: DataFrame, bucket: str = "1 hour", shards: int | None = None) -> DataFrame:
    """The rapid-use label on a stream: at least 8 transactions by the user within the last 60 s (open lower bound)."""
    return trailing(txn, S.RAPID_USE_WINDOW, S.RAPID_USE_MIN_EVENTS - 1, lower_inclusive=False, bucket=bucket,
                    count_col="rapid_count", flag_col="rapid_use", shards=shards)
