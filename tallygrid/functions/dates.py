"""Date helpers. Reference days are parameters; without one, today is used."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallygrid.functions.money import column

DAYS_PER_YEAR = 365.25


def day(as_of: dt.date | str | None) -> Column:
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def year_month(c: Column | str) -> Column:
    return F.date_format(column(c), "yyyy-MM")


def weekday_name(c: Column | str) -> Column:
    return F.date_format(column(c), "EEEE")


def parsed_date(c: Column | str) -> Column:
    """Date from ``yyyy-MM-dd`` text, null when the text is no such date."""
    return F.try_to_date(column(c), "yyyy-MM-dd")


def years_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start) / F.lit(DAYS_PER_YEAR)


def utc_instant(c: Column | str) -> Column:
    """The instant a zone-less timestamp names in UTC, whatever the session's zone."""
    c = column(c)
    seconds = F.extract(F.lit("SECOND"), c)
    return F.make_timestamp_ltz(
        F.year(c), F.month(c), F.day(c), F.hour(c), F.minute(c), seconds, F.lit("UTC")
    )


def utc_reading(c: Column | str) -> Column:
    """The zone-less reading of an instant in UTC."""
    local = column(c).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)
