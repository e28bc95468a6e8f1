import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallygrid.operators import customers, report
from tallygrid.operators import employees as emp
from tallygrid.operators import sales as ops


def many(make_sales, n=600):
    """Sales with ties, one busy day and some missing values."""
    return make_sales(*[
        {
            "sale_date": None if i % 97 == 0 else ("2024-03-05" if i % 3 else f"2024-03-{i % 28 + 1:02d}"),
            "total_amount": None if i % 89 == 0 else (i * i % 61) * 100 + 0.25,
            "customer_id": f"C{i % 17}",
            "customer_name": f"Name{i % 17}",
            "region": f"R{i % 5}",
            "category": f"K{i % 3}",
            "quantity": i % 4,
        }
        for i in range(n)
    ])


def test_clean_drops_repeated_headers_and_missing_ids(make_sales, rows_of):
    df = make_sales({"transaction_id": "transaction_id"}, {"transaction_id": None}, {})
    assert rows_of(ops.sales_clean(df), "transaction_id") == [("T3",)]


def test_date_parts_of_text_and_bad_text(spark, rows_of):
    df = spark.createDataFrame([("2024-08-09",), ("2024-08-xx",)], "sale_date string")
    assert rows_of(ops.sales_date_parts(df)) == [
        ("2024-08-09", "2024-08", "09", 9), ("2024-08-xx", "2024-08", "xx", None)]


def test_kpi_of_an_empty_table_is_one_row(make_sales):
    row = ops.sales_kpi_global(make_sales({}).where("quantity > 99")).first()
    assert (row["total_transactions"], row["total_revenue"], row["unique_customers"]) == (0, None, 0)


def test_grouped_reports(make_sales, rows_of):
    df = make_sales({"total_amount": 10.1, "quantity": 2}, {"total_amount": 20.2},
                    {"total_amount": 5.0, "category": "Toys", "region": "South",
                     "customer_id": "C2", "salesperson": "Eve", "sale_date": "2024-03-02"})
    assert rows_of(ops.sales_by_category(df)) == [
        ("Home", 2, 30.3, 15.15, 3, 10.0), ("Toys", 1, 5.0, 5.0, 1, 10.0)]
    assert rows_of(ops.sales_by_region(df)) == [
        ("North", 2, 30.3, 15.15, 1, 30.3), ("South", 1, 5.0, 5.0, 1, 5.0)]
    assert rows_of(ops.salesperson_performance(df)) == [
        ("Eve", 1, 5.0, 5.0, 1), ("Sam", 2, 30.3, 15.15, 1)]
    assert [r["daily_revenue"] for r in ops.sales_daily_trend(df).collect()] == [30.3, 5.0]
    assert rows_of(ops.mart_region(df)) == [("North", 30.3, 1, 15.15), ("South", 5.0, 1, 5.0)]
    assert rows_of(ops.mart_region_simple(df)) == [("North", 30.3, 2), ("South", 5.0, 1)]


def test_approximate_distinct_is_close(make_sales):
    df = many(make_sales)
    exact = {r["region"]: r["unique_customers"] for r in ops.sales_by_region(df).collect()}
    rough = {r["region"]: r["unique_customers"]
             for r in ops.sales_by_region(df, approximate=True).collect()}
    assert all(abs(rough[k] - exact[k]) <= 2 for k in exact)


def test_baskets(make_sales, rows_of):
    df = make_sales(*[{"quantity": q, "total_amount": 10.0} for q in (1, 1, 2, 3, 0, -1, None)])
    got = rows_of(ops.basket_analysis(df), "basket_size", "transaction_count")
    assert got == [("Large Basket (3+ items)", 1), ("Single Item", 2),
                   ("Small Basket (2 items)", 3), (None, 1)]
    assert ops.basket_analysis(df).agg(F.sum("revenue_percentage")).first()[0] == pytest.approx(100)


def test_top_products_are_cut_after_ordering(make_sales):
    df = make_sales(*[{"product_name": f"P{i}", "total_amount": float(i % 7)} for i in range(20)])
    got = [r["product_name"] for r in ops.top_products(df, 4).collect()]
    assert got == ["P13", "P6", "P12", "P19"]


def test_executive_line(make_sales):
    df = make_sales({"total_amount": 10.4, "quantity": 2}, {"total_amount": 21.3})
    assert ops.sales_executive_line(df, title="Q1").first()[0] == (
        "Q1 | Total transactions: 2 | Revenue: $32 | Average basket: $16 | Units sold: 3")


def test_anomaly_edges(make_sales, rows_of):
    df = make_sales(*[{"total_amount": a} for a in (2000.0, 2000.01)],
                    *[{"quantity": q} for q in (5, 6)],
                    *[{"unit_price": p} for p in (1500.0, 1500.01)])
    assert rows_of(ops.sales_anomalies(df), "transaction_id", "anomaly_type") == [
        ("T2", "HIGH_VALUE"), ("T4", "HIGH_VALUE"), ("T6", "HIGH_VALUE")]
    assert ops.sales_anomaly_summary(df).first()[0] == 3


def test_enriched(make_sales, rows_of):
    df = make_sales({"total_amount": 30.0, "quantity": 3}, {"quantity": 0})
    got = rows_of(ops.sales_enriched(df), "year_month", "day_of_week", "profit_margin",
                  "revenue_per_unit")
    assert got == [("2024-03", "Friday", 3.0, None), ("2024-03", "Friday", 9.0, 10.0)]


def test_running_total_equals_plain_window(make_sales, rows_of):
    df = many(make_sales)
    plain = df.select("transaction_id", F.round(
        F.sum("total_amount").over(Window.orderBy("sale_date")), 6).alias("t"))
    got = ops.sales_running_total(df).select(
        "transaction_id", F.round("running_total", 6).alias("t"))
    assert rows_of(got) == rows_of(plain)


@pytest.mark.parametrize("slots_per_octave", [128, 2])
def test_daily_rank_equals_plain_window(make_sales, rows_of, slots_per_octave):
    df = many(make_sales)
    by_day = Window.partitionBy("sale_date").orderBy(F.desc("total_amount"))
    plain = df.select("transaction_id", F.rank().over(by_day).cast("bigint").alias("daily_rank"))
    got = ops.sales_daily_rank(df, slots_per_octave)
    assert rows_of(got, "transaction_id", "daily_rank") == rows_of(plain)
    assert got.columns == [*df.columns, "daily_rank"]


def test_geography_shares_and_ranks(make_sales):
    got = ops.geographic_analysis(many(make_sales))
    shares = got.groupBy("region").agg(F.sum("market_share").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1) for r in shares)
    again = Window.partitionBy("category").orderBy(F.desc("revenue"))
    assert got.where(F.col("region_rank") != 0).withColumn(
        "r", F.rank().over(again)).where("r <> region_rank").count() == 0


def test_cube_and_rollup_equal_direct_grouping(make_sales, rows_of):
    df = many(make_sales)
    for ours, grouped in ((ops.sales_cube(df), df.cube("region", "category")),
                          (ops.sales_rollup(df), df.rollup("region", "category"))):
        direct = grouped.agg(F.grouping_id().alias("gid"), F.count("*").alias("n"))
        assert rows_of(ours, "region", "category", "gid", "n") == rows_of(
            direct, "region", "category", "gid", "n")


def test_product_margins(make_sales, rows_of):
    df = make_sales({"total_amount": 100.0}, {"total_amount": 300.0, "category": "Toys"})
    assert rows_of(ops.mart_product(df)) == [("Cup", 400.0, 2, 30.0)]
    assert rows_of(ops.mart_product(df, rates={"Toys": 0.5})) == [("Cup", 400.0, 2, 45.0)]


def test_executive_summary(make_sales, make_emp):
    got = report.executive_summary(
        make_emp({"salary": 10.0}, {"salary": 11.0, "city": "Oslo"}),
        make_sales({"total_amount": 1.5}, {"total_amount": 2.0, "customer_name": "Bob"}))
    assert [tuple(r) for r in got.collect()] == [
        ("Total Employees", "2", "HR"), ("Average Salary", "$10.50", "HR"),
        ("Departments", "1", "HR"), ("Cities", "2", "HR"),
        ("Total Transactions", "2", "Sales"), ("Total Revenue", "$3.50", "Sales"),
        ("Average Transaction", "$1.75", "Sales"), ("Unique Customers", "2", "Sales"),
        ("Unique Products", "1", "Sales")]
    assert emp.emp_total(make_emp({})).first()[0] == 1


def test_row_level_reports_keep_any_other_columns(make_sales, rows_of):
    extra = {name: F.lit(7) for name in ("n", "t", "below", "group_n", "slot", "first_sale", "inside")}
    df = make_sales({"total_amount": 1.0}, {"total_amount": 2.0}).withColumns(extra)
    for got, result in ((ops.sales_daily_rank(df), "daily_rank"),
                        (ops.sales_running_total(df), "running_total"),
                        (customers.customer_cohort(df), "customer_cohort")):
        assert got.columns[: len(df.columns)] == df.columns and result in got.columns
        assert rows_of(got, *extra) == [(7,) * len(extra)] * 2


def test_approximate_counts_are_near_the_exact_ones(make_emp, make_sales):
    sold = make_sales(*[{"customer_id": f"C{i}", "customer_name": f"N{i}", "region": "ab"[i % 2]} for i in range(60)])
    for r in ops.mart_region(sold, approximate=True).collect():
        assert abs(r["customers"] - 30) <= 3
    got = {r["metric"]: r["value"] for r in report.executive_summary(make_emp({}), sold, approximate=True).collect()}
    assert abs(int(got["Unique Customers"]) - 60) <= 6 and got["Unique Products"] == "1"
