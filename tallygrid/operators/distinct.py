"""Exact distinct counts that can be added up.

A count of distinct customers by region and one by category do not give the count by
both, and counting all of them anew for every grouping copies each sale once a grouping.
Here every distinct key gets a whole number, and each cell of a report a bitmap of the
numbers it has met. Bitmaps of cells are joined by *or*: cubes, roll-ups and any other
union of cells are counted from the bitmaps, and sales are read once.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.operators.spread import attach

LANES = 4096


def numbered(keys: DataFrame, key: str, lanes: int = LANES) -> DataFrame:
    """A whole number from 1 on for each of the distinct, non-null ``keys``.

    Keys are dealt into lanes by their hash and counted within each lane; number and lane
    are interleaved. So no task orders more than one key in ``lanes``, the numbers have few
    gaps, and they depend on the keys alone.
    """
    lane = F.pmod(F.xxhash64(key), F.lit(lanes))
    place = F.row_number().over(Window.partitionBy("__lane").orderBy(key)) - 1
    laid = keys.where(F.col(key).isNotNull()).select(key).distinct().withColumn("__lane", lane)
    return laid.select(key, (place.cast("long") * lanes + F.col("__lane") + 1).alias("__number"))


def distinct_bitmaps(df: DataFrame, cells: Sequence[str], key: str, lanes: int = LANES) -> DataFrame:
    """For each cell (a combination of ``cells``), bitmaps of the numbers of its distinct
    keys: the cells, ``bucket`` and ``bitmap``; a bucket stands for 32768 numbers.

    Rows are first reduced to one for each cell and key. Null keys are not counted, so a
    cell without a key has no bitmap. The result can be stored, and that of later rows
    added by ``union`` as long as the numbers are the same.
    """
    pairs = df.where(F.col(key).isNotNull()).groupBy(*cells, key).agg(F.lit(1).alias("__one")).drop("__one")
    known = attach(pairs, numbered(pairs, key, lanes), [key], "inner")
    return known.groupBy(*cells, F.bitmap_bucket_number("__number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__number")).alias("bitmap"))


def _counted(grouped, name: str, *others) -> DataFrame:
    return grouped.agg(*others, F.bitmap_count(F.bitmap_or_agg("bitmap")).alias(name))


def distinct_by_grouping(bitmaps: DataFrame, cells: Sequence[str], kind: str = "cube",
                         name: str = "distinct") -> DataFrame:
    """Distinct keys for every grouping of a ``cube`` or ``rollup`` of the cells: cells, ``gid``
    (of these cells alone) and the count. Only the few rows of the bitmaps are multiplied."""
    if kind == "cube":
        sets = [s for n in range(len(cells), -1, -1) for s in combinations(cells, n)]
    elif kind == "rollup":
        sets = [tuple(cells[:n]) for n in range(len(cells), -1, -1)]
    else:
        raise ValueError(f"{kind} is neither cube nor rollup")
    # The bucket is in every set, so its bit, the first of the grouping id, is 0.
    grouped = bitmaps.groupingSets([("bucket", *s) for s in sets], "bucket", *cells)
    by_bucket = _counted(grouped, "__n", F.grouping_id().alias("gid"))
    return by_bucket.groupBy(*cells, "gid").agg(F.sum("__n").alias(name))


def distinct_in_unions(bitmaps: DataFrame, cells: Sequence[str], unions: DataFrame, label: str,
                       name: str = "distinct") -> DataFrame:
    """Distinct keys in any unions of cells: ``unions`` has a row for each label and cell
    that belongs to it, cells may belong to several labels. Null cells match null."""
    wanted = unions.select(label, *(F.col(c).alias(f"__{c}") for c in cells)).distinct()
    match = F.lit(True)
    for c in cells:
        match = match & F.col(c).eqNullSafe(F.col(f"__{c}"))
    by_bucket = _counted(bitmaps.join(wanted, match).groupBy(label, "bucket"), "__n")
    return by_bucket.groupBy(label).agg(F.sum("__n").alias(name))
