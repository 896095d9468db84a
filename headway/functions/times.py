"""Clock and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECS = 86_400


def clock_secs(text: Column) -> Column:
    """Seconds since the start of the service day of an ``H:mm:ss`` text.

    Hours may pass 24 (a trip that runs after midnight), which no timestamp parser
    accepts. Text that is not a clock time gives NULL.
    """
    parts = F.split(F.trim(text), ":")
    hours, minutes, seconds = (F.get(parts, i).try_cast("int") for i in range(3))
    return hours * 3600 + minutes * 60 + F.coalesce(seconds, F.lit(0))


def clock_text(secs: Column) -> Column:
    return F.format_string(
        "%02d:%02d:%02d",
        F.floor(secs / 3600).cast("int"),
        F.floor(secs / 60).cast("int") % 60,
        secs % 60,
    )


def service_date(yyyymmdd: Column) -> Column:
    return F.try_to_date(F.trim(yyyymmdd.cast("string")), "yyyyMMdd")


def epoch_day(epoch_secs: Column) -> Column:
    """UTC calendar date of epoch seconds, independent of the session time zone."""
    days = F.floor(epoch_secs / DAY_SECS).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)
