"""Distinct counts for any span of days, from a sketch stored for each day.

A sketch is a few kilobytes whatever it has counted, and sketches of days can be joined.
A new day adds its own sketches and reads nothing of the days before; a span reads
sketches only. Counts are estimates: with ``lg_size`` 12 their standard error is 1.6 %.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_SIZE = 12


def standard_error(lg_size: int = LG_SIZE) -> float:
    """Of an estimate, relative, for sketches of 2 ** ``lg_size`` cells."""
    return 1.04 / (1 << lg_size) ** 0.5


def daily_sketches(df: DataFrame, day: str, key: str, by: Sequence[str] = (), lg_size: int = LG_SIZE) -> DataFrame:
    """A sketch of the distinct keys of each day (and of each value of ``by``): day, by, sketch.
    Null keys are not counted; rows without a day have a null day."""
    return df.groupBy(F.col(day).cast("date").alias("day"), *by).agg(
        F.hll_sketch_agg(key, F.lit(lg_size)).alias("sketch"))


def distinct_in_spans(sketches: DataFrame, spans: DataFrame, by: Sequence[str] = (), name: str = "distinct") -> DataFrame:
    """Estimated distinct keys of each span: ``spans`` has label, first and last day, which
    may overlap. A span in which no day has a sketch is left out."""
    days = spans.where(F.col("first_day") <= F.col("last_day")).select(
        "label", F.explode(F.sequence("first_day", "last_day")).alias("day")).distinct()
    return sketches.join(days, "day").groupBy("label", *by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
