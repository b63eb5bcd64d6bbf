"""Timestamps as long positions in microseconds, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from barflow.series import MICROSECOND, Series


def floor_div(value: Column, by: int) -> Column:
    """Exact integer floor division, also below zero."""
    return F.call_function("div", value - F.pmod(value, F.lit(by)), F.lit(by))


def is_ntz(df: DataFrame, ts: str) -> bool:
    kind = df.schema[ts].dataType
    if not isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"{ts} must be a timestamp, not {kind.simpleString()}")
    return isinstance(kind, T.TimestampNTZType)


def micros(df: DataFrame, ts: str) -> Column:
    col = F.col(ts)
    if not is_ntz(df, ts):
        return F.unix_micros(col)
    # unix_timestamp reads wall-clock timestamps without a zone; the fraction of the second is added.
    fraction = (F.extract(F.lit("SECOND"), col) * F.lit(1_000_000)).cast("long") % F.lit(1_000_000)
    return F.unix_timestamp(col) * F.lit(1_000_000) + fraction


def from_micros(at: Column, ntz: bool) -> Column:
    if not ntz:
        return F.timestamp_micros(at)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.lit(MICROSECOND) * at


def chunk_of(at: Column, series: Series) -> Column:
    return floor_div(at, series.span_us)


def epoch_to_timestamp(seconds: Column) -> Column:
    """Unix seconds to a timestamp, without a round trip through session-zone text."""
    return F.timestamp_seconds(seconds)


def parse_timestamp(text: Column, pattern: str | None = None) -> Column:
    """Text to timestamp; null instead of an error where the text does not parse."""
    return F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)
