"""Column-expression helpers. All are built-in Spark expressions (codegen'd)."""

from cardwatch.functions.columns import (  # noqa: F401
    EPOCH_NTZ,
    epoch_micros,
    from_epoch_micros,
    floor_time,
    interval_micros,
    round_half_up,
    hour_as_written,
    to_utc_ntz,
)
