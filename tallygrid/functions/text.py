"""Text forms of numbers for reports and exports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallygrid.functions.money import column

SIZE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB")


def two_decimals(c: Column | str) -> Column:
    return F.call_function("format_number", column(c), F.lit("0.00"))


def dollars(c: Column | str) -> Column:
    """``$1234.50``"""
    return F.concat(F.lit("$"), two_decimals(c))


def grouped_dollars(c: Column | str) -> Column:
    """``$1,234.50``"""
    return F.concat(F.lit("$"), F.format_number(column(c), 2))


def grouped_integer(c: Column | str) -> Column:
    """``1,234``"""
    return F.format_number(column(c), 0)


def byte_size(c: Column | str) -> Column:
    """Size in the largest unit below which it stays under 1024, up to PB."""
    size = column(c).cast("double")
    out = F.when(size.isNull(), F.lit(None).cast("string"))
    for power, unit in enumerate(SIZE_UNITS[:-1]):
        scaled = size / float(1024**power)
        out = out.when(scaled < 1024.0, F.concat(two_decimals(scaled), F.lit(f" {unit}")))
    last = size / float(1024 ** (len(SIZE_UNITS) - 1))
    return out.otherwise(F.concat(two_decimals(last), F.lit(f" {SIZE_UNITS[-1]}")))


def whole(c: Column | str) -> Column:
    """Rounded to a long."""
    return F.round(column(c), 0).cast("bigint")


def whole_text(c: Column | str) -> Column:
    return whole(c).cast("string")
