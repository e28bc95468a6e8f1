"""Joins and rankings that hold when one key has a large part of all rows.

A window partitioned by such a key sends the whole key to one task. Here the
rows are first reduced to one row per key (or per key and value) with partial
aggregation, and the result is joined back. The join is laid out so that
adaptive execution can split an oversized key over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.functions.money import exact_total, other_total, put_together, ratio, rows


def attach(df: DataFrame, facts: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Add the columns of ``facts`` (one row per key) to every row; null keys match.

    Adaptive execution splits a skewed join partition only when both join inputs
    come straight from a shuffle. ``facts`` is usually an aggregate already laid
    out by the same keys, which would be joined without a shuffle of its own and
    so switch the splitting off. Joining on a hash of the keys as well gives the
    (small) fact side its own shuffle and keeps the splitting on. The hash comes
    first, so that a sort for the join seldom looks at the other keys.
    """
    taken = {k: f"__fact_{k}" for k in keys}
    facts = facts.withColumnsRenamed(taken)
    same_hash = F.xxhash64(*taken.keys()) == F.xxhash64(*taken.values())
    same_keys = (F.col(k).eqNullSafe(F.col(t)) for k, t in taken.items())
    match = reduce(lambda a, b: a & b, same_keys, same_hash)
    return df.join(facts, match, how).drop(*taken.values())


def standings(df: DataFrame, group: str, value: str, slots_per_octave: int = 128) -> DataFrame:
    """Where each distinct value stands within its group.

    Columns: group, value, ``__n`` (rows with the value), ``__below`` (rows of the
    group with a smaller value; null counts as smallest), ``__group_n`` (rows of
    the group) and ``__group_mean`` (mean of the group's non-null values).

    Equal values are counted before anything is ordered. Values are then ordered
    within slots, and the slots within the group. A slot spans a fixed ratio of
    values, ``slots_per_octave`` to a doubling: amounts of any size up to 9e12 fall
    into at most 86 * slots_per_octave slots, and by default a slot of amounts in
    cents has at most 55,000 distinct values at 100,000 and 550,000 at a million.
    So no task ever orders a whole group.
    """
    size = F.floor(F.log2(F.abs(F.col(value).cast("double")) + 1.0) * slots_per_octave)
    slot = (
        F.when(F.isnan(value), F.lit(2**63 - 1))
        .when(F.col(value) < 0, -size)
        .otherwise(size)
    )
    counted = df.groupBy(group, value).agg(rows().alias("__n")).withColumn("__slot", slot)

    per_slot = counted.groupBy(group, "__slot").agg(
        F.sum("__n").alias("__slot_n"),
        exact_total(value, times="__n").alias("__slot_total"),
        other_total(value, times="__n").alias("__slot_other"),
        F.sum(F.when(F.col(value).isNotNull(), F.col("__n"))).alias("__slot_known"),
    )
    whole_group = Window.partitionBy(group)
    up_to = whole_group.orderBy("__slot").rowsBetween(Window.unboundedPreceding, 0)
    slots = per_slot.select(
        group,
        "__slot",
        (F.sum("__slot_n").over(up_to) - F.col("__slot_n")).alias("__earlier"),
        F.sum("__slot_n").over(whole_group).alias("__group_n"),
        ratio(put_together(F.sum("__slot_total").over(whole_group),
                           F.sum("__slot_other").over(whole_group)), F.sum("__slot_known").over(whole_group)).alias(
            "__group_mean"
        ),
    )

    inside = (
        Window.partitionBy(group, "__slot").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = counted.withColumn("__inside", F.sum("__n").over(inside) - F.col("__n"))
    placed = attach(placed, slots, [group, "__slot"])
    below = (F.col("__earlier") + F.col("__inside")).alias("__below")
    return placed.select(group, value, "__n", below, "__group_n", "__group_mean")
