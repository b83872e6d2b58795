"""Wire codec: JSON bytes <-> typed transaction columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch import schema as S
from cardwatch.functions import to_utc_ntz


def decode(raw: DataFrame, value: str = "value", ingest_time: str | None = "timestamp",
           fields: list[str] | None = None, keep_raw: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``from_json(cast(value as string))`` flattened to the 17 wire fields.

    Bad text yields an all-NULL record (``from_json`` is permissive); pair it
    with :func:`cardwatch.operators.quality.validate` to quarantine such rows.
    Only ``fields`` are parsed; ``keep`` carries other columns of ``raw`` (e.g.
    the record key) through.  The record is a generator's one row: a filter on
    its fields (a validation) stays above it, where a projection would be
    parsed again for every field that the filter names.
    """
    text = F.col(value).cast("string")
    wanted = fields or S.TRANSACTION_FIELDS
    rest = []
    if ingest_time and ingest_time in raw.columns:
        rest.append(F.col(ingest_time).alias("ingest_time"))
    if keep_raw:
        rest.append(text.alias("raw_value"))
    rest += [F.col(c) for c in (keep or [])]
    record = F.from_json(text, T.StructType([S.TRANSACTION_SCHEMA[f] for f in wanted]))
    return raw.select(F.inline(F.array(record)), *rest)


def json_value(fields: list[str] | None = None) -> Column:
    """JSON text of the wire fields (NULL fields are left out, as ``to_json`` does)."""
    return F.to_json(F.struct(*[F.col(f) for f in (fields or S.TRANSACTION_FIELDS)]))


def encode(df: DataFrame, fields: list[str] | None = None, key: str | None = "user_id") -> DataFrame:
    """(key, value) pair for a keyed topic: key = user id, value = JSON of the wire fields."""
    cols = [json_value(fields).alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)


def parse_event_time(text: Column) -> Column:
    """ISO-8601 text -> TIMESTAMP_NTZ in UTC; NULL for text that is no timestamp.

    ``try_to_timestamp`` honours the text's own offset; the absolute instant
    is then written as UTC wall-clock time so no session zone leaks in.
    """
    return to_utc_ntz(F.try_to_timestamp(F.upper(text)))  # a lower-case t or z is allowed


def with_event_time(df: DataFrame, text: str = "timestamp", out: str = "event_time") -> DataFrame:
    return df.withColumn(out, parse_event_time(F.col(text)))
