"""Distinct counts from bitmaps against counting anew."""

import pytest
from pyspark.sql import functions as F

from tallygrid.operators import distinct, sales
from tests.test_scale import plan


@pytest.fixture(scope="module")
def cells(spark):
    """A customer with a third of all rows, null keys and null cells, and a key in every cell."""
    n = F.col("id")
    return spark.range(0, 60_000, 1, 6).select(
        F.when(n % 4 != 0, F.concat(F.lit("r"), n % 4)).alias("region"),
        F.when(n % 7 != 0, F.concat(F.lit("c"), (n * 31) % 5)).alias("category"),
        F.when(n % 3 == 0, "hot").when(n % 11 != 0, F.concat(F.lit("k"), (n * 7919) % 9001)).alias("customer_id"),
        (n % 100 / 4).alias("total_amount"))


def rows(df, *names):
    return sorted(map(repr, map(tuple, df.select(*names).collect())))


@pytest.mark.parametrize("kind", ["cube", "rollup"])
def test_groupings_equal_distinct_counts(cells, kind):
    bitmaps = distinct.distinct_bitmaps(cells, ["region", "category"], "customer_id", lanes=16)
    got = distinct.distinct_by_grouping(bitmaps, ["region", "category"], kind)
    anew = getattr(cells, kind)("region", "category").agg(
        F.grouping_id().alias("gid"), F.count_distinct("customer_id").alias("distinct"))
    names = ("region", "category", "gid", "distinct")
    assert rows(got, *names) == rows(anew, *names)


def test_numbers_are_unique_and_nearly_dense(cells):
    got = distinct.numbered(cells, "customer_id", lanes=16).agg(
        F.count("*"), F.count_distinct("__number"), F.min("__number"), F.max("__number")).first()
    n = cells.agg(F.count_distinct("customer_id")).first()[0]
    assert got[0] == got[1] == n and got[2] >= 1 and got[3] < 1.3 * n


def test_bitmaps_do_not_depend_on_partitions_and_can_be_joined(cells):
    bitmaps = distinct.distinct_bitmaps(cells, ["region"], "customer_id")
    other = distinct.distinct_bitmaps(cells.repartition(13), ["region"], "customer_id")
    assert rows(bitmaps, "region", "bucket", "bitmap") == rows(other, "region", "bucket", "bitmap")
    twice = distinct.distinct_by_grouping(bitmaps.unionByName(other), ["region"])
    assert rows(twice, "region", "distinct") == rows(distinct.distinct_by_grouping(bitmaps, ["region"]), "region", "distinct")


def test_more_keys_than_a_bucket_holds(spark):
    many = spark.range(100_000).select(F.lit("x").alias("region"), F.col("id").cast("string").alias("key"))
    bitmaps = distinct.distinct_bitmaps(many, ["region"], "key")
    assert bitmaps.count() > 2
    assert {r["distinct"] for r in distinct.distinct_by_grouping(bitmaps, ["region"]).collect()} == {100_000}


def test_unions_of_cells(spark, cells):
    unions = spark.createDataFrame(
        [("a", "r1", "c1"), ("a", "r1", "c2"), ("a", "r1", "c1"), ("b", None, "c1"), ("b", "r2", None), ("none", "x", "y")],
        "market string, region string, category string")
    got = dict(map(tuple, sales.market_customers(cells, unions).collect()))

    def count(where):
        return cells.where(where).agg(F.count_distinct("customer_id")).first()[0]

    assert got == {"a": count("region = 'r1' and category in ('c1', 'c2')"),
                   "b": count("(region is null and category = 'c1') or (region = 'r2' and category is null)")}


def test_empty_and_keyless(cells):
    for df in (cells.where("false"), cells.where("customer_id is null")):
        bitmaps = distinct.distinct_bitmaps(df, ["region", "category"], "customer_id")
        assert distinct.distinct_by_grouping(bitmaps, ["region", "category"]).count() == 0
    none = sales.sales_cube_customers(cells.where("customer_id is null"))
    assert {r["customers"] for r in none.collect()} == {0}
    with pytest.raises(ValueError):
        distinct.distinct_by_grouping(cells, ["region"], "sets")


def test_sales_are_not_multiplied(cells):
    """The expansion stands above the cells' aggregates."""
    text = plan(sales.sales_cube_customers(cells))
    assert "Expand" in text
    for part in text.split("Expand")[1:]:
        assert "HashAggregate" in part.split("Range")[0] or "ObjectHashAggregate" in part.split("Range")[0]
