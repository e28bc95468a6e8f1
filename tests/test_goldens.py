"""The figures of FIXTURES.md on tables of that shape, with the operators' own cuts."""

import datetime as dt

import pytest

from tallygrid.operators import customers, documents, employees, report, sales

# Fixed values of FIXTURES.md: department, employees, salaries least and largest and in all,
# and years of age in all (the rounded mean age times the number).
DEPARTMENTS = {
    "Engineering": (15, 75000, 95000, 1251000, 541),
    "Marketing": (13, 65000, 94000, 1043000, 471),
    "Finance": (12, 63000, 81000, 850000, 386),
    "HR": (10, 58000, 80000, 654000, 294),
}
# Category, sales, revenue, units and mean unit price.
CATEGORIES = {
    "Electronics": (15, 18099.79, 21, 899.99),
    "Furniture": (9, 5099.88, 12, 433.3233),
    "Appliances": (9, 1599.87, 13, 127.7678),
    "Clothing": (8, 1559.88, 12, 139.99),
    "Sports": (9, 1259.86, 14, 94.4344),
}


def spread(total, n, step=1):
    """``n`` numbers of whole steps that add up to ``total``."""
    each = round(total / n / step) * step
    return [each] * (n - 1) + [round(total - each * (n - 1), 2)]


@pytest.fixture(scope="module")
def emp(make_emp):
    rows = []
    for department, (n, low, high, total, years) in DEPARTMENTS.items():
        pay = [low, high, *spread(total - low - high, n - 2, 100)]
        rows += [dict(department=department, salary=float(s), age=a) for s, a in zip(pay, spread(years, n))]
    for i, row in enumerate(rows):
        row["city"] = f"city {i}"
    return make_emp(*rows)


@pytest.fixture(scope="module")
def sold(make_sales):
    rows, day = [], dt.date(2024, 8, 1)
    for category, (n, revenue, units, price) in CATEGORIES.items():
        parts = zip(spread(revenue, n, 0.01), spread(units, n), spread(round(price * n, 2), n, 0.01))
        rows += [dict(category=category, total_amount=a, quantity=q, unit_price=p) for a, q, p in parts]
    return make_sales(*[{**r, "customer_name": f"N{i}", "customer_id": f"C{i}", "sale_date": day + dt.timedelta(days=i % 25)}
                        for i, r in enumerate(rows)])


def test_workforce(emp, rows_of):
    assert employees.emp_total(emp).first()[0] == 50
    assert employees.emp_anomaly_count(emp).first()[0] == 0
    got = {r["department"]: r for r in employees.emp_department_stats(emp).collect()}
    means = {"Engineering": 83400.0, "Marketing": 80230.7692, "Finance": 70833.3333, "HR": 65400.0}
    ages = {"Engineering": 36.0667, "Marketing": 36.2308, "Finance": 32.1667, "HR": 29.4}
    for name, (n, low, high, total, _) in DEPARTMENTS.items():
        r = got[name]
        assert (r["employee_count"], r["min_salary"], r["max_salary"]) == (n, low, high)
        assert (round(r["avg_salary"], 4), round(r["avg_age"], 4)) == (means[name], ages[name])
    mart = {r["department"]: r for r in employees.mart_department(emp).collect()}
    assert {d: r["total_salary"] for d, r in mart.items()} == {d: float(v[3]) for d, v in DEPARTMENTS.items()}
    assert {d: r["pct_of_total"] for d, r in mart.items()} == {"Engineering": 32.9, "Marketing": 27.5, "Finance": 22.4, "HR": 17.2}
    assert [r["department"] for r in employees.emp_department_stats(emp).collect()] == list(DEPARTMENTS)


def test_sales(sold):
    r = sales.sales_kpi_global(sold).first()
    assert (r["total_transactions"], r["total_revenue"], r["avg_transaction_value"], r["total_units_sold"],
            r["unique_customers"]) == (50, 27619.28, 552.3856, 72, 50)
    got = sales.sales_by_category(sold).collect()
    assert [r["category"] for r in got] == list(CATEGORIES)
    means = [1206.6527, 566.6533, 177.7633, 194.985, 139.9844]
    for r, (n, revenue, units, price), mean in zip(got, CATEGORIES.values(), means):
        assert (r["transaction_count"], r["total_revenue"], r["total_quantity"]) == (n, revenue, units)
        assert round(r["avg_transaction_value"], 4) == mean and r["avg_unit_price"] == pytest.approx(price, abs=6e-4)
    assert sales.sales_daily_trend(sold).count() == 25
    assert customers.vip_customers(sold).count() == 0
    assert sales.sales_executive_line(sold).first()[0] == (
        "SALES EXECUTIVE REPORT | Total transactions: 50 | Revenue: $27619 | Average basket: $552 | Units sold: 72")
    last = sales.sales_running_total(sold).agg({"running_total": "max"}).first()[0]
    assert last == 27619.28
    cohorts = customers.customer_cohort(sold)
    assert {tuple(r) for r in cohorts.select("customer_cohort", "period_number").collect()} == {("2024-08", 0.0)}


def test_summary(emp, sold):
    got = {r["metric"]: r["value"] for r in report.executive_summary(emp, sold).collect()}
    assert got["Total Employees"] == "50" and got["Average Salary"] == "$75960.00" and got["Departments"] == "4"
    assert got["Total Transactions"] == "50" and got["Total Revenue"] == "$27619.28"
    assert got["Average Transaction"] == "$552.39" and got["Unique Customers"] == "50"


def test_rfm_points_of_single_purchases(make_sales):
    """One purchase each: recency and amount alone decide, as in the figures."""
    recent = dict(sale_date="2024-08-25")
    old = dict(sale_date="2024-08-01")
    sold = make_sales(*[{**when, "customer_name": f"{k}", "total_amount": amount}
                        for k, (when, amount) in enumerate([(old, 99.0), (recent, 99.0), (recent, 600.0), (recent, 1299.99)])])
    got = sorted((r["customer_name"], r["rfm_score"], r["customer_segment"])
                 for r in customers.customer_rfm(sold, as_of="2024-08-31").collect())
    assert got == [("0", 3, "New Customers"), ("1", 5, "Potential Loyalists"), ("2", 6, "Loyal Customers"),
                   ("3", 7, "Loyal Customers")]


def test_documents(spark):
    shape = ("product struct<category: string>, sale_info struct<quantity: int, total_amount: double>, "
             "location struct<region: string>")
    docs = spark.createDataFrame([(("Electronics",), (1, 1299.99), ("Europe",)), (("Electronics",), (2, 679.98), ("Europe",)),
                                  (("Electronics",), (1, 699.99), ("Asia",))], shape)
    assert tuple(documents.doc_category_rollup(docs).first()) == ("Electronics", 3, 2679.96)
    r = documents.doc_category_sales(docs).first()
    assert (r["total_quantity"], r["avg_price"]) == (4, 669.99)
    regions = {r["region"]: (r["total_sales"], r["transactions"], r["avg_transaction"])
               for r in documents.doc_region_rollup(docs).collect()}
    assert regions == {"Europe": (1979.97, 2, 989.985), "Asia": (699.99, 1, 699.99)}
