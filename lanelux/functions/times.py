"""Time stamps without time zone, parsed without touching the session zone."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_CLOCK = r" (\d{1,2}):(\d{1,2}):(\d{1,2})"


def _day_first(text: Column, sep: str) -> Column:
    pattern = rf"^(\d{{1,2}}){sep}(\d{{1,2}}){sep}(\d{{4}}){_CLOCK}$"
    iso = F.when(text.rlike(pattern), F.regexp_replace(text, pattern, "$3-$2-$1 $4:$5:$6"))
    return iso.try_cast("timestamp_ntz")


def measure_time(text: Column) -> Column:
    """``d/M/yyyy H:m:s`` when the text holds a slash, ISO otherwise; else NULL."""
    iso = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), text).try_cast("timestamp_ntz")
    return F.when(text.contains("/"), _day_first(text, "/")).otherwise(iso)


def measure_time_legacy(text: Column) -> Column:
    """Day first, with slashes or dashes."""
    return _day_first(F.replace(text, F.lit("/"), F.lit("-")), "-")


def iso_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 19)


def stamp(at: datetime.datetime) -> Column:
    """A constant time stamp; as text, because a time literal would be moved to the session zone."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def in_year(ts: Column, year: int) -> Column:
    """A half-open range, so the scan can use column statistics."""
    return (ts >= stamp(datetime.datetime(year, 1, 1))) & (ts < stamp(datetime.datetime(year + 1, 1, 1)))
