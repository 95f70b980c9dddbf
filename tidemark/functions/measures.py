"""Ages, guarded ratios and JSON texts used by the checks and reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

NEVER_DAYS = 999


def at(moment: datetime) -> Column:
    """A moment as a timestamp without zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def as_instant(col: Column) -> Column:
    """Wall time taken as UTC, as a timestamp with zone; the zone of the session plays no part."""
    span = col.cast("timestamp_ntz") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    minutes = (F.extract(F.lit("DAY"), span) * 24 + F.extract(F.lit("HOUR"), span)) * 60
    seconds = (minutes + F.extract(F.lit("MINUTE"), span)).cast("bigint") * 60
    micros = (F.extract(F.lit("SECOND"), span) * 1_000_000).cast("bigint")
    return F.timestamp_micros(seconds * 1_000_000 + micros)


def wall_time(col: Column) -> Column:
    """A timestamp with zone as wall time in UTC; the zone of the session plays no part."""
    seconds = F.unix_micros(col).cast("decimal(24,0)") / 1_000_000
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def days_since(ts: Column, as_of: datetime) -> Column:
    """Midnights between a timestamp and `as_of`; 999 when there is none."""
    return F.coalesce(F.datediff(at(as_of), ts), F.lit(NEVER_DAYS))


def hours_since(ts: Column, as_of: datetime) -> Column:
    """Hour marks between a timestamp and `as_of`."""
    return F.timestamp_diff("HOUR", F.date_trunc("hour", ts), F.date_trunc("hour", at(as_of)))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 when there is no whole."""
    return F.when(whole != 0, part / whole).otherwise(F.lit(0.0)).cast("double")


def rounded(col: Column, digits: int) -> Column:
    """Rounded as a binary double, so that 0.00015 (a little less in binary) gives 0.0001."""
    scale = F.lit(float(10**digits))
    return F.round(col * scale) / scale


def tags_json(tags: Column) -> Column:
    """Map of tags as JSON with sorted keys, so equal tags give equal texts."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(tags))))
