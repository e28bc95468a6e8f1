import math
import statistics
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallygrid.functions import bands, dates, money, text


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()["x"]


def test_exact_sum_does_not_depend_on_order(spark):
    cents = [(i * 7919 % 1_000_003) / 100 for i in range(20_000)]
    df = spark.createDataFrame([(c,) for c in cents], "x double")
    expected = sum(round(c * 100) for c in cents) / 100
    for parts in (1, 7, 64):
        got = df.repartition(parts).agg(money.exact_sum("x").alias("s")).first()["s"]
        assert got == expected


def test_exact_sum_handles_negative_null_and_empty(spark):
    df = spark.createDataFrame([(-0.01,), (None,), (-1234.56,), (0.02,)], "x double")
    assert df.agg(money.exact_sum("x").alias("s")).first()["s"] == -1234.55
    assert df.where("x > 1e9").agg(money.exact_sum("x").alias("s")).first()["s"] is None
    assert df.agg(money.exact_mean("x").alias("m")).first()["m"] == pytest.approx(-1234.55 / 3)


def test_exact_sum_passes_the_range_of_a_long(spark):
    """Millionths of 4e12 fit a long; the sum of ten of them does not."""
    df = spark.range(10).select(F.lit(4_000_000_000_000.25).alias("x"))
    assert df.agg(money.exact_sum("x").alias("s")).first()["s"] == 40_000_000_000_002.5


@pytest.mark.parametrize("values", [
    [(i * 7919 % 1_000_003) / 100 for i in range(5_000)],
    [1_000_000_000.01 + i / 100 for i in range(300)],
    [-5.5, 1e7, 0.000001, -3.25],
    [2.0, 2.0],
])
def test_exact_deviation_does_not_depend_on_order(spark, values):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "x double")
    found = {df.repartition(n).agg(money.exact_deviation("x").alias("s")).first()["s"] for n in (1, 7, 64)}
    assert len(found) == 1
    exact = statistics.stdev([Fraction(round(v * 10**6), 10**6) for v in values])
    assert found.pop() == pytest.approx(float(exact), rel=1e-14)


def test_deviation_of_few_and_of_odd_values(spark):
    def of(*values):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(money.exact_deviation("x").alias("s")).first()["s"]

    assert of() is None and of(None) is None and of(5.0) is None and of(5.0, None) is None
    assert of(1 / 3, 2 / 3, 5.0) == pytest.approx(statistics.stdev([1 / 3, 2 / 3, 5.0]))
    assert of(8.9e12, -8.9e12) == pytest.approx(statistics.stdev([8.9e12, -8.9e12]))
    assert of(1e15, 3e15) == pytest.approx(statistics.stdev([1e15, 3e15]))
    assert math.isnan(of(float("nan"), 1.0))


def test_exact_total_counts_repeated_values(spark):
    df = spark.createDataFrame([(1.25, 4), (-0.5, 3)], "x double, n bigint")
    assert float(df.agg(money.exact_total("x", times="n").alias("s")).first()["s"]) == 3.5


def test_division_by_zero_gives_null_or_zero(spark):
    assert one(spark, money.ratio("a", "b"), a=1.0, b=0.0) is None
    assert one(spark, money.ratio_or_zero("a", "b"), a=1.0, b=0) == 0.0
    assert one(spark, money.ratio_or_zero("a", "b"), a=1.0, b=4) == 0.25


@pytest.mark.parametrize("value,label", [
    (29, "low"), (30, "mid"), (39, "mid"), (40, "high"), (None, None)])
def test_bands_are_closed_below_and_keep_null(spark, value, label):
    c = bands.below_bands(F.lit(value).cast("int"), (30, 40), ("low", "mid", "high"))
    assert one(spark, c) == label


@pytest.mark.parametrize("value,points", [(7, 3), (8, 2), (14, 2), (15, 1), (None, 1)])
def test_points_at_most(spark, value, points):
    assert one(spark, bands.points_at_most(F.lit(value).cast("int"), (7, 14))) == points


@pytest.mark.parametrize("value,points", [
    (1000.0, 3), (999.99, 2), (500.0, 2), (499.99, 1), (None, 1)])
def test_points_at_least(spark, value, points):
    assert one(spark, bands.points_at_least(F.lit(value).cast("double"), (1000, 500))) == points


def test_band_tables_must_fit():
    with pytest.raises(ValueError):
        bands.below_bands("x", (1, 2), ("a", "b"))
    with pytest.raises(ValueError):
        bands.first_reached("x", (1,), ("a",))


@pytest.mark.parametrize("size,shown", [
    (0, "0.00 B"), (1023, "1023.00 B"), (1024, "1.00 KB"), (1152, "1.12 KB"),
    (1024**2 - 1, "1024.00 KB"), (5 * 1024**3, "5.00 GB"), (3 * 1024**5, "3.00 PB"),
    (5000 * 1024**5, "5000.00 PB"), (-5, "-5.00 B")])
def test_byte_sizes_look_like_the_usual_formatting(spark, size, shown):
    assert one(spark, text.byte_size(F.lit(float(size)))) == shown


def test_money_and_number_text(spark):
    assert one(spark, text.dollars(F.lit(1234.5))) == f"${1234.5:.2f}"
    assert one(spark, text.dollars(F.lit(0.125))) == f"${0.125:.2f}"
    assert one(spark, text.grouped_dollars(F.lit(1234567.891))) == f"${1234567.891:,.2f}"
    assert one(spark, text.grouped_integer(F.lit(1234567))) == f"{1234567:,}"
    assert one(spark, text.whole(F.lit(2.5))) == 3


def test_unreadable_dates_become_null(spark):
    assert one(spark, dates.parsed_date(F.lit("31/12/2020"))) is None
    assert str(one(spark, dates.parsed_date(F.lit("2020-12-31")))) == "2020-12-31"
    assert one(spark, dates.day(None)) is not None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**14, 10**14), min_size=1, max_size=40))
def test_exact_total_of_any_cents(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double").repartition(3)
    total = df.agg(money.exact_total("x").alias("t")).first()["t"]
    micros = sum(round(c / 100 * 1_000_000) for c in cents)
    assert int(total.scaleb(6)) == micros


@pytest.mark.parametrize("amounts,total", [
    ([1.5, float("inf")], float("inf")), ([1e13, 1e13, 0.25], 2e13 + 0.25), ([1e-7] * 1000, 1e-4),
    ([float("inf"), float("-inf")], float("nan")), ([float("nan"), 2.0], float("nan")),
    ([None, None], None), ([None, 1e300], 1e300), ([0.1 + 0.2], 0.3)])
def test_exact_sum_of_any_double(spark, amounts, total):
    df = spark.createDataFrame([(x,) for x in amounts], "x double")
    got = df.agg(money.exact_sum("x").alias("s")).first()["s"]
    assert got == total if total is None else got == pytest.approx(total, rel=1e-12, nan_ok=True)


def test_exact_sum_of_many_large_amounts(spark):
    df = spark.range(3_000_000).select(F.lit(8.9e12).alias("x"))
    assert df.agg(money.exact_sum("x").alias("s")).first()["s"] == 3_000_000 * 8.9e12
