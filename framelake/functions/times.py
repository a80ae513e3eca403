"""Column functions on timestamps and frame plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unix_seconds(value: Column, zone: str = "UTC") -> Column:
    """Seconds as a double from a number, numeric text or ISO-8601 text; naive text is local to ``zone``; else null."""
    text = F.trim(value.cast("string"))
    aware = text.rlike(r"(Z|[+-]\d\d:?\d\d)$")
    there = F.when(aware, F.try_to_timestamp(text)).otherwise(F.to_utc_timestamp(F.try_to_timestamp(F.concat(text, F.when(F.length(text) == 10, F.lit("T00:00:00Z")).otherwise(F.lit("Z")))), zone))
    return F.coalesce(text.try_cast("double"), F.unix_micros(there) / 1000000.0)


def utc_text(seconds: Column, pattern: str) -> Column:
    """Formats epoch seconds in UTC whatever the session zone."""
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.timestamp_micros((seconds * 1000000).cast("long")).cast("timestamp_ntz")), pattern)


def day_key(seconds: Column) -> Column:
    return utc_text(seconds, "yyyyMMdd")


def partition_path(seconds: Column, camera: Column, ident: Column) -> Column:
    return F.concat_ws("/", day_key(seconds), camera, ident)


def time_bucket(seconds: Column, zone: str = "UTC") -> Column:
    """night before 5, dawn before 9, day before 17, dusk before 21, then night, by the hour in ``zone``."""
    hour = F.hour(F.convert_timezone(F.current_timezone(), F.lit(zone), F.timestamp_micros((seconds * 1000000).cast("long")).cast("timestamp_ntz")))
    return F.when(seconds.isNull(), None).when(hour < 5, "night").when(hour < 9, "dawn").when(hour < 17, "day").when(hour < 21, "dusk").otherwise("night")


def frame_times(start: Column, end: Column, n: int, min_gap: float = 2.0) -> Column:
    """Up to n times spread over [start, end], at least min_gap apart; [start] without a range."""
    span = end - start
    count = F.least(F.lit(n), (F.floor(span / min_gap) + 1).cast("int"))
    even = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.round(F.least(F.greatest(start + span * (i / (count - 1)), start), end), 3))
    single = F.array(start)
    if n <= 1:
        return single
    return F.when(end.isNull() | (span <= 0) | (count <= 1), single).when(count == 2, F.array(start, end)).otherwise(even)
