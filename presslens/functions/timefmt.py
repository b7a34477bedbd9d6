"""Time expressions: buckets, feed date parsing, spans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket(ts: Column, minutes: int = 15) -> Column:
    """Start of the tumbling ``minutes`` bucket (equals hour + floor(minute/m)*m for m | 60)."""
    return F.window(ts, f"{minutes} minutes").start


def span_hours(min_ts: Column, max_ts: Column) -> Column:
    """Hours between two wall-clock timestamps (no session-zone/DST dependence)."""
    return F.timestamp_diff("MICROSECOND", min_ts, max_ts) / F.lit(3.6e9)


def parse_feed_date(raw: Column) -> Column:
    """RFC-822 (with or without weekday, GMT/UT/Z or numeric zone) or ISO-8601
    feed date -> UTC TIMESTAMP_NTZ; NULL when unparseable."""
    s = F.regexp_replace(raw, r"^\s+|\s+$", "")
    s = F.regexp_replace(s, r"^[A-Za-z]{3},\s*", "")
    s = F.regexp_replace(s, r"\s+(GMT|UTC|UT|Z)$", " +0000")
    rfc = F.coalesce(
        F.try_to_timestamp(s, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(s, F.lit("d MMM yyyy HH:mm Z")),
    )
    iso = F.coalesce(
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXXX")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH:mm:ss")),
    )
    return instant_to_utc_ntz(F.coalesce(rfc, iso))


def instant_to_utc_ntz(ltz: Column) -> Column:
    """An instant (TIMESTAMP) as UTC wall-clock TIMESTAMP_NTZ, independent of the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ltz), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def round_half_up(c: Column, digits: int) -> Column:
    """Half-up rounding done identically by Spark and DuckDB (floor(x*10^d+0.5)/10^d)."""
    scale = float(10 ** digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def round_half_up_sql(x: str, digits: int) -> str:
    scale = float(10 ** digits)
    return f"(floor(({x}) * {scale} + 0.5) / {scale})"


def ntz_to_instant(ntz: Column) -> Column:
    """A UTC wall-clock TIMESTAMP_NTZ as an instant (TIMESTAMP), independent of
    the session zone (needed for watermarks, which reject NTZ)."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ntz)
    return F.timestamp_micros(micros)
