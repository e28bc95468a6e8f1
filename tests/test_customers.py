import pytest
from pyspark.sql import functions as F

from tallygrid.operators import customers as ops


def test_vip_needs_more_than_the_minimum(make_sales, rows_of):
    df = make_sales(*[{"customer_name": n, "total_amount": 1.1, "quantity": 2} for n in "ABBCCC"])
    assert rows_of(ops.vip_customers(df)) == [("C", 3, 3.3, 3.3 / 3, 6)]


def test_key_is_a_choice(make_sales, rows_of):
    df = make_sales(*[{"customer_name": "Same", "customer_id": c} for c in ("1", "1", "2")])
    assert rows_of(ops.vip_customers(df, 2), "purchase_frequency") == [(3,)]
    assert ops.vip_customers(df, 2, key="customer_id").count() == 0


@pytest.mark.parametrize("day,count,amount,score,segment", [
    ("2024-03-24", 1, 1000.0, 7, "Loyal Customers"),
    ("2024-03-23", 2, 500.0, 7, "Loyal Customers"),
    ("2024-03-24", 3, 400.0, 9, "Champions"),
    ("2024-03-16", 1, 499.99, 3, "New Customers"),
    ("2024-03-17", 1, 999.99, 5, "Potential Loyalists"),
])
def test_rfm_edges(make_sales, rows_of, day, count, amount, score, segment):
    df = make_sales(*[{"sale_date": day, "total_amount": amount}] * count)
    got = ops.customer_rfm(df, as_of="2024-03-31")
    assert rows_of(got, "frequency", "rfm_score", "customer_segment") == [(count, score, segment)]


def test_segments_split_the_customers(make_sales):
    df = make_sales(*[{"customer_name": f"N{i % 37}", "total_amount": i * 3.0,
                       "sale_date": f"2024-03-{i % 28 + 1:02d}"} for i in range(300)])
    rfm = ops.customer_rfm(df, as_of="2024-03-31")
    assert ops.rfm_segment_counts(rfm).agg(F.sum("count")).first()[0] == 37
    mart = ops.mart_customer_segments(rfm).agg(F.sum("count"), F.sum("total_revenue")).first()
    assert tuple(mart) == (37, sum(i * 3.0 for i in range(300)))


def test_cohort_months(make_sales, rows_of):
    dates = ["2024-08-31", "2024-09-30", "2024-10-15", "2024-08-31"]
    df = make_sales(*[{"sale_date": d} for d in dates],
                    {"customer_name": "B", "sale_date": "2024-01-31"},
                    {"customer_name": "B", "sale_date": "2024-03-15"},
                    {"customer_name": None, "sale_date": "2023-01-01"})
    got = {r["transaction_id"]: (r["customer_cohort"], r["period_number"])
           for r in ops.customer_cohort(df).collect()}
    assert got["T1"] == got["T4"] == ("2024-08", 0.0)
    assert got["T2"] == ("2024-08", 1.0)
    assert got["T3"] == ("2024-08", round(2 - 16 / 31, 8))
    assert got["T6"] == ("2024-01", round(2 - 16 / 31, 8))
    assert got["T7"] == ("2023-01", 0.0)


def test_affinity_counts_products_and_purchases(make_sales, rows_of):
    df = make_sales({"product_name": "B"}, {"product_name": "A"}, {"product_name": "B"},
                    {"product_name": None}, {"customer_name": "Zoe", "product_name": None})
    assert rows_of(ops.customer_affinity(df)) == sorted(
        [("Ann", "A", 1, 3), ("Ann", "B", 2, 3), ("Ann", None, 1, 3), ("Zoe", None, 1, 0)], key=repr)


def test_affinity_has_one_shape_for_a_huge_customer(spark):
    """A third of all purchases and one product bought very often by one customer."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("c"), (F.col("id") % 500).cast("string"))).alias("customer_name"),
        F.when(F.col("id") % 6 == 0, "often").otherwise(
            F.concat(F.lit("p"), (F.col("id") % 211).cast("string"))).alias("product_name"),
    )
    found = ops.customer_affinity(df)
    plain = df.groupBy("customer_name", "product_name").count()
    assert found.drop("product_count").exceptAll(plain).count() == 0 and found.count() == plain.count()
    hot = found.where("customer_name = 'hot'").agg(F.sum("times_bought"), F.min("product_count")).first()
    assert tuple(hot) == (10_000, 10_000)


def test_product_counts_hold_every_purchase(make_sales, rows_of):
    df = make_sales({"product_name": "B"}, {"product_name": "A"}, {"product_name": "B"})
    assert rows_of(ops.customer_product_counts(df)) == [("Ann", "A", 1), ("Ann", "B", 2)]


def test_features_have_mean_zero_and_deviation_one(make_sales):
    df = make_sales(*[{"customer_name": f"N{i % 13}", "total_amount": float(i * i % 101),
                       "sale_date": f"2024-03-{i % 28 + 1:02d}"} for i in range(200)])
    row = ops.customer_features(df, as_of="2024-04-01").agg(
        *[f(c) for c in "rfm" for f in (F.avg, F.stddev)]).first()
    assert list(row) == pytest.approx([0, 1] * 3, abs=1e-9)


def test_features_without_spread_are_null(make_sales, rows_of):
    assert rows_of(ops.customer_features(make_sales({}), "2024-04-01"), "r", "f", "m") == [
        (None, None, None)]


def test_customer_360_and_its_gaps(spark, make_sales, rows_of):
    docs = spark.createDataFrame([("C1", "Ann", "Gold"), ("C9", "Zoe", None)],
                                 "customer_id string, name string, loyalty_tier string")
    df = make_sales({"total_amount": 1.1}, {"total_amount": 2.2}, {"customer_id": "C2"})
    assert rows_of(ops.customer_360(df, docs)) == [
        ("C1", "Ann", "Gold", 2, 3.3, True), ("C2", None, None, 1, 10.0, False)]
    assert rows_of(ops.customers_without_sales(df, docs)) == [("C9",)]
    assert rows_of(ops.sales_without_customer(df, docs)) == [("C2",)]
