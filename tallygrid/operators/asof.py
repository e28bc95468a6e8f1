"""As-of joins: the version of a fact that was valid at a row's time.

A window over a key's rows and versions sends the whole key to one task. Here a key's
time is cut into buckets. What a bucket needs from before it is its key's last version so
far, which is carried from bucket to bucket in a table with one row for each key and
bucket; rows meet versions inside their own bucket only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.operators.spread import attach


def as_of_join(rows: DataFrame, versions: DataFrame, key: str, time: str, valid_from: str,
               columns: Sequence[str], bucket: str = "month", strict: bool = False,
               newest: Sequence[str] = ()) -> DataFrame:
    """Every row of ``rows`` with ``columns`` of its key's latest version, by ``valid_from``,
    that is not later than the row's ``time``, or is earlier if ``strict``; null without one.

    Of versions of a key from one moment the one with the largest ``newest`` counts, then
    with the largest ``columns``. Rows and versions without key or time match nothing.
    ``bucket`` is a unit of time. Rows are reduced to one for each key and moment, and joined
    back in a way that lets a hot key and moment be split, so a third of all rows may have
    one key, and even one moment.
    """
    facts = F.struct(*columns)
    order = F.struct(*newest, *columns)
    known = versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).groupBy(
        F.col(key).alias("__key"), F.col(valid_from).alias("__at")).agg(F.max_by(facts, order).alias("__fact"))
    asked = rows.where(F.col(key).isNotNull() & F.col(time).isNotNull()).groupBy(
        F.col(key).alias("__key"), F.col(time).alias("__at")).agg(F.lit(1).alias("__n"))
    span = F.date_trunc(bucket, F.col("__at"))
    known, asked = known.withColumn("__span", span), asked.withColumn("__span", span)

    last = known.groupBy("__key", "__span").agg(F.max_by("__fact", "__at").alias("__last"))
    spans = asked.select("__key", "__span", F.lit(None).cast(last.schema["__last"].dataType).alias("__last"))
    per_span = spans.distinct().unionByName(last).groupBy("__key", "__span").agg(F.first("__last", True).alias("__last"))
    earlier = Window.partitionBy("__key").orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_span.select("__key", "__span", F.last("__last", True).over(earlier).alias("__carried"))

    # Within a moment a version stands before the rows that may see it, or after them.
    version_first = F.lit(1 if strict else 0)
    both = known.select("__key", "__span", "__at", version_first.alias("__turn"), "__fact").unionByName(
        asked.select("__key", "__span", "__at", F.lit(1 - (1 if strict else 0)).alias("__turn"),
                     F.lit(None).cast(known.schema["__fact"].dataType).alias("__fact")))
    inside = Window.partitionBy("__key", "__span").orderBy("__at", "__turn").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("__seen", F.last("__fact", True).over(inside)).where(
        F.col("__turn") == (0 if strict else 1))
    found = attach(seen, carried, ["__key", "__span"]).select(
        F.col("__key"), F.col("__at"), F.coalesce("__seen", "__carried").alias("__valid"))
    out = attach(rows, found.withColumnsRenamed({"__key": key, "__at": time}), [key, time])
    return out.select(*rows.columns, *(F.col(f"__valid.{c}").alias(c) for c in columns))
