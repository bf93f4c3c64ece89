"""Clock and integer helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms(ts: Column) -> Column:
    """Whole milliseconds since the epoch; the grain of every as-of comparison."""
    return F.unix_millis(ts)


def floor_div(value: Column, by: Column | int) -> Column:
    """Whole-number division rounding down, also below zero and beyond 2**53."""
    by = F.lit(by).cast("bigint") if isinstance(by, int) else by
    return F.call_function("div", value - F.pmod(value, by), by)


def wall_clock(ts: Column) -> Column:
    """Zone-less UTC timestamp, the type of the fact table."""
    return ts.cast("timestamp_ntz")


def from_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)
