"""As-of joins against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallygrid.operators.asof import as_of_join
from tests.test_scale import final_plan, no_broadcast  # noqa: F401

START = dt.date(2024, 1, 1)


def brute(rows, versions, strict):
    out = []
    for i, key, time in rows:
        best = None
        for k, at, number, name in versions:
            if key is None or time is None or k != key or at is None:
                continue
            if (at < time if strict else at <= time) and (best is None or (at, number, name) > best):
                best = (at, number, name)
        out.append((i, key, time, best[1] if best else None, best[2] if best else None))
    return sorted(out, key=repr)


def found(spark, rows, versions, strict, bucket="month"):
    left = spark.createDataFrame(rows, "i int, key string, time date")
    right = spark.createDataFrame(versions, "key string, at date, number int, name string")
    got = as_of_join(left, right, "key", "time", "at", ["number", "name"], bucket, strict)
    assert got.columns == ["i", "key", "time", "number", "name"]
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("bucket", ["week", "year"])
def test_against_brute_force(spark, strict, bucket):
    """Ties of moment, keys without a version before them, gaps over many buckets, nulls, and
    repeated rows."""
    draw = random.Random(1)
    keys = ["hot"] * 6 + ["b", "c", None, "no versions"]

    def day():
        return None if draw.random() < 0.05 else START + dt.timedelta(days=draw.randrange(900))

    rows = [(i, draw.choice(keys), day()) for i in range(400)]
    rows += rows[:20]
    versions = [(draw.choice(keys[:9]), day(), draw.randrange(5), draw.choice("xyz")) for _ in range(60)]
    assert found(spark, rows, versions, strict, bucket) == brute(rows, versions, strict)


def test_empty_sides(spark):
    rows = [(1, "a", START)]
    assert found(spark, rows, [], False) == [(1, "a", START, None, None)]
    assert found(spark, [], [("a", START, 1, "x")], False) == []


def test_a_hot_key_and_moment_is_split(spark, no_broadcast):  # noqa: F811
    n = F.col("id")
    rows = spark.range(0, 200_000, 1, 8).select(
        F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (n % 9001).cast("string"))).alias("key"),
        F.when(n % 3 == 0, F.lit(START)).otherwise(F.date_add(F.lit(START), (n % 300).cast("int"))).alias("time"),
        n.alias("i"))
    versions = rows.where(n % 50 == 0).select("key", F.col("time").alias("at"), F.col("i").alias("number"))
    got = as_of_join(rows, versions, "key", "time", "at", ["number"])
    assert "skew=true" in final_plan(got)
    assert got.where("key = 'hot'").agg(F.count_distinct("number")).first()[0] == 1
