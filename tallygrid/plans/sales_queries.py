"""Sales queries. Each asks the star for the columns it needs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrid.operators import employees as emp
from tallygrid.operators import report
from tallygrid.operators import sales as ops
from tallygrid.plans.catalog import query
from tallygrid.plans.oracle import mean, over, total
from tallygrid.sources import sinks
from tallygrid.sources.scratch import fresh_folder

ODD = {"max_amount": 104000, "max_quantity": 49, "max_price": 52000}
ODD_SALE = "total_amount > 104000 OR quantity > 49 OR unit_price > 52000"
COLUMNS = """transaction_id, product_id, product_name, category, quantity, unit_price, total_amount,
  customer_id, customer_name, sale_date, region, salesperson"""


@query("sales_clean", over(f"SELECT {COLUMNS} FROM sales WHERE transaction_id <> 'transaction_id'"))
def _(star):
    return ops.sales_clean(star.sales())


@query("sales_date_parts", over(f"""
SELECT {COLUMNS}, substr(sale_date::varchar, 1, 7) AS year_month,
       substr(sale_date::varchar, 9, 2) AS day,
       substr(sale_date::varchar, 9, 2)::int AS day_of_month
FROM sales"""))
def _(star):
    return ops.sales_date_parts(star.sales())


@query("sales_kpi_global", over(f"""
SELECT count(*) AS total_transactions, {total('total_amount')} AS total_revenue,
       {mean('total_amount')} AS avg_transaction_value, sum(quantity)::bigint AS total_units_sold,
       count(DISTINCT customer_id) AS unique_customers FROM sales"""))
def _(star):
    return ops.sales_kpi_global(star.sales("total_amount", "quantity", "customer_id"))


@query("sales_by_category", over(f"""
SELECT category, count(*) AS transaction_count, {total('total_amount')} AS total_revenue,
       {mean('total_amount')} AS avg_transaction_value, sum(quantity)::bigint AS total_quantity,
       {mean('unit_price')} AS avg_unit_price
FROM sales GROUP BY category ORDER BY total_revenue DESC, category"""))
def _(star):
    return ops.sales_by_category(star.sales("category", "total_amount", "quantity", "unit_price"))


@query("sales_by_region", over(f"""
SELECT region, count(*) AS transactions, {total('total_amount')} AS revenue,
       {mean('total_amount')} AS avg_order_value, count(DISTINCT customer_id) AS unique_customers,
       {total('total_amount')} / count(DISTINCT customer_id) AS revenue_per_customer
FROM sales GROUP BY region"""))
def _(star):
    return ops.sales_by_region(star.sales("region", "total_amount", "customer_id"))


@query("salesperson_performance", over(f"""
SELECT salesperson, count(*) AS total_sales, {total('total_amount')} AS total_revenue,
       {mean('total_amount')} AS avg_sale_amount, count(DISTINCT customer_id) AS customers_served
FROM sales GROUP BY salesperson"""))
def _(star):
    return ops.salesperson_performance(star.sales("salesperson", "total_amount", "customer_id"))


@query("sales_daily_trend", over(f"""
SELECT sale_date, count(*) AS daily_transactions, {total('total_amount')} AS daily_revenue,
       {mean('total_amount')} AS avg_daily_transaction
FROM sales GROUP BY sale_date ORDER BY sale_date"""))
def _(star):
    return ops.sales_daily_trend(star.sales("sale_date", "total_amount"))


@query("top_products", over(f"""
SELECT product_name, count(*) AS times_sold, sum(quantity)::bigint AS total_quantity_sold,
       {total('total_amount')} AS total_product_revenue, {mean('unit_price')} AS avg_unit_price
FROM sales GROUP BY product_name ORDER BY total_product_revenue DESC, product_name LIMIT 10"""))
def _(star):
    return ops.top_products(star.sales("product_name", "quantity", "total_amount", "unit_price"))


@query("basket_analysis", over(f"""
SELECT CASE WHEN quantity = 10 THEN 'Ten Items'
            WHEN quantity <= 25 THEN 'Up to 25 Items'
            WHEN quantity > 25 THEN 'Over 25 Items' END AS basket_size,
       count(*) AS transaction_count, {total('total_amount')} AS revenue_contribution,
       {mean('total_amount')} AS avg_transaction_value,
       {total('total_amount')} * 100.0::double
         / sum(sum(total_amount::decimal(18,2))) OVER () ::double AS revenue_percentage
FROM sales GROUP BY 1"""))
def _(star):
    return ops.basket_analysis(star.sales("quantity", "total_amount"), edges=(10, 25),
                               labels=("Ten Items", "Up to 25 Items", "Over 25 Items"))


@query("sales_executive_line", over(f"""
SELECT 'SALES EXECUTIVE REPORT | Total transactions: ' || count(*)
       || ' | Revenue: $' || round({total('total_amount')})::bigint
       || ' | Average basket: $' || round({mean('total_amount')})::bigint
       || ' | Units sold: ' || sum(quantity)::bigint AS executive_line
FROM sales"""))
def _(star):
    return ops.sales_executive_line(star.sales("total_amount", "quantity"))


@query("sales_anomaly_summary", over(f"""
SELECT count(*) AS anomaly_count, {total('total_amount')} AS anomaly_revenue
FROM sales WHERE {ODD_SALE}"""))
def _(star):
    return ops.sales_anomaly_summary(star.sales("quantity", "unit_price", "total_amount"), **ODD)


@query("sales_anomaly_details", over(f"""
SELECT transaction_id, product_name, quantity, unit_price, total_amount, customer_name,
       'HIGH_VALUE' AS anomaly_type FROM sales WHERE {ODD_SALE}"""))
def _(star):
    wanted = ("transaction_id", "product_name", "quantity", "unit_price", "total_amount",
              "customer_name")
    return ops.sales_anomalies(star.sales(*wanted), **ODD)


#: Sales at a hundredth of their amount, the range that the operators' own cuts are made for.
SMALL = "small AS (SELECT * REPLACE (total_amount / 100 AS total_amount, unit_price / 100 AS unit_price) FROM sales)"


def small(star, *columns):
    sales = star.sales(*columns)
    return sales.withColumns({c: F.col(c) / 100 for c in ("total_amount", "unit_price") if c in columns})


@query("sales_anomalies_usual", over(f"""
WITH {SMALL}
SELECT transaction_id, product_name, quantity, unit_price, total_amount, customer_name,
       'HIGH_VALUE' AS anomaly_type FROM small
WHERE total_amount > 2000 OR quantity > 5 OR unit_price > 1500"""))
def _(star):
    return ops.sales_anomalies(small(star, "transaction_id", "product_name", "quantity", "unit_price",
                                     "total_amount", "customer_name"))


@query("basket_analysis_usual", over(f"""
SELECT CASE WHEN quantity = 1 THEN 'Single Item' WHEN quantity <= 2 THEN 'Small Basket (2 items)'
            WHEN quantity > 2 THEN 'Large Basket (3+ items)' END AS basket_size,
       count(*) AS transaction_count, {total('total_amount')} AS revenue_contribution,
       {mean('total_amount')} AS avg_transaction_value,
       {total('total_amount')} * 100.0::double
         / sum(sum(total_amount::decimal(18,2))) OVER () ::double AS revenue_percentage
FROM sales GROUP BY 1"""))
def _(star):
    return ops.basket_analysis(star.sales("quantity", "total_amount"))


@query("sales_enriched", over(f"""
SELECT {COLUMNS}, strftime(sale_date, '%Y-%m') AS year_month, dayname(sale_date) AS day_of_week,
       total_amount * 0.3::double AS profit_margin, total_amount / quantity AS revenue_per_unit
FROM sales"""))
def _(star):
    return ops.sales_enriched(star.sales())


@query("sales_running_total", over(f"""
SELECT {COLUMNS},
       (sum(total_amount::decimal(18,2)) OVER (ORDER BY sale_date))::double AS running_total
FROM sales"""))
def _(star):
    return ops.sales_running_total(
        star.sales(), amounts=star.sales("sale_date", "total_amount"))


def daily_rank(star):
    return ops.sales_daily_rank(star.sales(), amounts=star.sales("sale_date", "total_amount"))


@query("sales_daily_rank", over(f"""
SELECT {COLUMNS},
       rank() OVER (PARTITION BY sale_date ORDER BY total_amount DESC) AS daily_rank
FROM sales"""))
def _(star):
    """Sales of more than one piece are ranked piece by piece, into a scratch folder."""
    if star.n_pieces() == 1:
        return daily_rank(star)
    path = fresh_folder(star.spark, "daily_rank")
    for piece in star.pieces(by_day=True):
        ranked = daily_rank(piece)
        sinks.add_rows(ranked, path)
    return star.spark.read.schema(ranked.schema).parquet(path)


@query("geographic_analysis", over(f"""
SELECT region, category, {total('total_amount')} AS revenue, count(*) AS transactions,
       count(DISTINCT customer_name) AS unique_customers, {mean('total_amount')} AS avg_transaction,
       {total('total_amount')}
         / (sum(sum(total_amount::decimal(18,2))) OVER (PARTITION BY region))::double AS market_share,
       (rank() OVER (PARTITION BY category ORDER BY sum(total_amount::decimal(18,2)) DESC))::int
         AS region_rank
FROM sales GROUP BY region, category"""))
def _(star):
    return ops.geographic_analysis(
        star.sales("region", "category", "total_amount", "customer_name"))


GROUPING = """SELECT region, category, grouping(region) * 2 + grouping(category) AS gid,
       {total} AS revenue, count(*) AS n FROM sales GROUP BY {kind} (region, category)"""


@query("sales_cube", over(GROUPING.format(total=total("total_amount"), kind="CUBE")))
def _(star):
    return ops.sales_cube(star.sales("region", "category", "total_amount"))


@query("sales_rollup", over(GROUPING.format(total=total("total_amount"), kind="ROLLUP")))
def _(star):
    return ops.sales_rollup(star.sales("region", "category", "total_amount"))


CUSTOMERS = GROUPING.replace("count(*) AS n", "count(*) AS n, count(DISTINCT customer_id) AS customers")


@query("sales_cube_customers", over(CUSTOMERS.format(total=total("total_amount"), kind="CUBE")))
def _(star):
    return ops.sales_cube_customers(star.sales("region", "category", "total_amount", "customer_id"))


@query("sales_rollup_customers", over(CUSTOMERS.format(total=total("total_amount"), kind="ROLLUP")))
def _(star):
    return ops.sales_rollup_customers(star.sales("region", "category", "total_amount", "customer_id"))


#: A cell of region and category belongs to the market of its region, and to one that all
#: categories with the same first letter make.
@query("market_customers", over("""
SELECT market, count(DISTINCT customer_id) AS customers FROM (
  SELECT 'region ' || region AS market, customer_id FROM sales UNION ALL
  SELECT 'letter ' || category[1], customer_id FROM sales) GROUP BY market"""))
def _(star):
    cells = star.sales("region", "category").distinct()
    markets = cells.select("region", "category", F.explode(F.array(
        F.concat(F.lit("region "), "region"), F.concat(F.lit("letter "), F.substring("category", 1, 1)))).alias("market"))
    return ops.market_customers(star.sales("region", "category", "customer_id"), markets)


@query("mart_region", over(f"""
SELECT region, {total('total_amount')} AS revenue, count(DISTINCT customer_id) AS customers,
       {mean('total_amount')} AS avg_order FROM sales GROUP BY region"""))
def _(star):
    return ops.mart_region(star.sales("region", "total_amount", "customer_id"))


@query("mart_region_simple", over(f"""
SELECT region, {total('total_amount')} AS revenue, count(*) AS transactions
FROM sales GROUP BY region"""))
def _(star):
    return ops.mart_region_simple(star.sales("region", "total_amount"))


@query("mart_product", over(f"""
SELECT product_name AS product, {total('total_amount')} AS sales, sum(quantity)::bigint AS units,
       30.0::double AS margin FROM sales GROUP BY product_name"""))
def _(star):
    return ops.mart_product(star.sales("product_name", "total_amount", "quantity"))


@query("mart_product_rates", over(f"""
SELECT product_name AS product, {total('total_amount')} AS sales, sum(quantity)::bigint AS units,
       round(sum(total_amount::decimal(18,2) * CASE category WHEN 'ECONOMY' THEN 0.25
         WHEN 'PROMO' THEN 0.5 ELSE 0.3 END)::double / {total('total_amount')} * 100, 6) AS margin
FROM sales GROUP BY product_name"""))
def _(star):
    return ops.mart_product(star.sales("product_name", "category", "total_amount", "quantity"),
                            rates={"ECONOMY": 0.25, "PROMO": 0.5})


def _metric(source: str, kind: str, lines: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS metric, {value} AS value, '{kind}' AS type FROM {source}"
        for name, value in lines.items())


@query("executive_summary", over(
    _metric("emp", "HR", {
        "Total Employees": "count(*)::varchar",
        "Average Salary": f"printf('$%.2f', {mean('salary')})",
        "Departments": "count(DISTINCT department)::varchar",
        "Cities": "count(DISTINCT city)::varchar",
    }) + " UNION ALL " + _metric("sales", "Sales", {
        "Total Transactions": "count(*)::varchar",
        "Total Revenue": f"printf('$%.2f', {total('total_amount')})",
        "Average Transaction": f"printf('$%.2f', {mean('total_amount')})",
        "Unique Customers": "count(DISTINCT customer_name)::varchar",
        "Unique Products": "count(DISTINCT product_name)::varchar",
    })))
def _(star):
    return report.executive_summary(
        emp.emp_clean(star.employees()),
        star.sales("total_amount", "customer_name", "product_name"))
