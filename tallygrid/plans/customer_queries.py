"""Customer queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrid.operators import customers as ops
from tallygrid.operators import quality
from tallygrid.operators.asof import as_of_join
from tallygrid.operators.sketches import daily_sketches, distinct_in_spans, standard_error
from tallygrid.plans.catalog import query
from tallygrid.plans.oracle import deviation, int_mean, mean, over, total
from tallygrid.plans.sales_queries import COLUMNS

AS_OF = "2001-08-02"
RFM = {"as_of": AS_OF, "recency": (120, 300), "frequency": (45, 35),
       "monetary": (2_400_000, 1_800_000)}
RFM_COLUMNS = ("customer_name", "sale_date", "transaction_id", "total_amount")
RFM_SQL = f"""
WITH numbers AS (
SELECT customer_name, max(sale_date) AS last_purchase_date, count(transaction_id) AS frequency,
       {total('total_amount')} AS monetary_value, {mean('total_amount')} AS avg_order_value,
       date_diff('day', max(sale_date), date '{AS_OF}')::int AS recency_days
FROM sales GROUP BY customer_name), scored AS (
SELECT *, CASE WHEN recency_days <= 120 THEN 3 WHEN recency_days <= 300 THEN 2 ELSE 1 END
        + CASE WHEN frequency >= 45 THEN 3 WHEN frequency >= 35 THEN 2 ELSE 1 END
        + CASE WHEN monetary_value >= 2400000 THEN 3 WHEN monetary_value >= 1800000 THEN 2
               ELSE 1 END AS rfm_score
FROM numbers), rfm AS (
SELECT *, CASE WHEN rfm_score >= 8 THEN 'Champions' WHEN rfm_score >= 6 THEN 'Loyal Customers'
               WHEN rfm_score >= 4 THEN 'Potential Loyalists' ELSE 'New Customers' END
          AS customer_segment
FROM scored)"""


@query("vip_customers", over(f"""
SELECT customer_name, count(*) AS purchase_frequency, {total('total_amount')} AS total_spent,
       {mean('total_amount')} AS avg_order_value, sum(quantity)::bigint AS total_items_bought
FROM sales GROUP BY customer_name HAVING count(*) > 60"""))
def _(star):
    sales = star.sales("customer_name", "total_amount", "quantity")
    return ops.vip_customers(sales, min_purchases=60)


@query("vip_customers_usual", over(f"""
SELECT customer_name, count(*) AS purchase_frequency, {total('total_amount')} AS total_spent,
       {mean('total_amount')} AS avg_order_value, sum(quantity)::bigint AS total_items_bought
FROM sales GROUP BY customer_name HAVING count(*) > 2"""))
def _(star):
    return ops.vip_customers(star.sales("customer_name", "total_amount", "quantity"))


USUAL_RFM = RFM_SQL
for cut, usual in (("<= 120", "<= 7"), ("<= 300", "<= 14"), (">= 45", ">= 3"), (">= 35", ">= 2"),
                   (">= 2400000", ">= 1000"), (">= 1800000", ">= 500")):
    USUAL_RFM = USUAL_RFM.replace(cut, usual)


@query("customer_rfm_usual", over(USUAL_RFM + "SELECT * FROM rfm"))
def _(star):
    return ops.customer_rfm(star.sales(*RFM_COLUMNS), as_of=AS_OF)


def rfm(star):
    return ops.customer_rfm(star.sales(*RFM_COLUMNS), **RFM)


@query("customer_rfm", over(RFM_SQL + "SELECT * FROM rfm"))
def _(star):
    return rfm(star)


@query("rfm_segment_counts", over(RFM_SQL + """
SELECT customer_segment, count(*) AS count FROM rfm GROUP BY customer_segment"""))
def _(star):
    return ops.rfm_segment_counts(rfm(star))


@query("mart_customer_segments", over(RFM_SQL + f"""
SELECT customer_segment AS segment, count(*) AS count, {mean('monetary_value')} AS avg_value,
       {total('monetary_value')} AS total_revenue FROM rfm GROUP BY customer_segment"""))
def _(star):
    return ops.mart_customer_segments(rfm(star))


@query("customer_cohort", over(f"""
WITH since AS (
SELECT *, min(sale_date) OVER (PARTITION BY customer_name) AS first_sale FROM sales),
gaps AS (
SELECT *, ((year(sale_date) - year(first_sale)) * 12 + month(sale_date) - month(first_sale))::double
          AS months FROM since)
SELECT {COLUMNS}, strftime(first_sale, '%Y-%m') AS customer_cohort,
       CASE WHEN day(sale_date) = day(first_sale)
              OR (sale_date = last_day(sale_date) AND first_sale = last_day(first_sale)) THEN months
            ELSE round(months + (day(sale_date) - day(first_sale)) / 31.0::double, 8)
       END AS period_number
FROM gaps"""))
def _(star):
    return ops.customer_cohort(star.sales(), visits=star.sales("customer_name", "sale_date"))


@query("customer_affinity", over("""
SELECT customer_name, product_name, count(*) AS times_bought,
       sum(count(product_name)) OVER (PARTITION BY customer_name)::bigint AS product_count
FROM sales GROUP BY customer_name, product_name"""))
def _(star):
    return ops.customer_affinity(star.sales("customer_name", "product_name"))


@query("customer_product_counts", over("""
SELECT customer_name, product_name, count(*) AS times_bought
FROM sales GROUP BY customer_name, product_name"""))
def _(star):
    return ops.customer_product_counts(star.sales("customer_name", "product_name"))


@query("customer_features", over(RFM_SQL + f"""
, moments AS (
SELECT {int_mean('recency_days')} AS r_mean, {deviation('recency_days')} AS r_deviation,
       {int_mean('frequency')} AS f_mean, {deviation('frequency')} AS f_deviation,
       {mean('monetary_value')} AS m_mean, {deviation('monetary_value')} AS m_deviation FROM numbers)
SELECT customer_name, (recency_days - r_mean) / r_deviation AS r, (frequency - f_mean) / f_deviation AS f,
       (monetary_value - m_mean) / m_deviation AS m
FROM numbers, moments"""))
def _(star):
    return ops.customer_features(star.sales(*RFM_COLUMNS), as_of=AS_OF)


@query("customer_360", over(f"""
WITH bought AS (
SELECT customer_id, count(*) AS orders, {total('total_amount')} AS revenue
FROM sales GROUP BY customer_id)
SELECT bought.customer_id, name, loyalty_tier, orders, revenue, name IS NOT NULL AS matched
FROM bought LEFT JOIN cust ON bought.customer_id = cust.customer_id"""))
def _(star):
    return ops.customer_360(star.sales("customer_id", "total_amount"), star.customer_documents())


@query("customers_without_sales", over("""
SELECT customer_id FROM cust WHERE customer_id NOT IN (SELECT customer_id FROM sales)"""))
def _(star):
    return ops.customers_without_sales(star.sales("customer_id"), star.customer_documents())


@query("sales_without_customer", over("""
SELECT DISTINCT customer_id FROM sales
WHERE customer_id NOT IN (SELECT customer_id FROM cust)"""))
def _(star):
    return ops.sales_without_customer(star.sales("customer_id"), star.customer_documents())


@query("dq_unique_keys", over("""
SELECT 'customer_id' AS key, customer_id AS value, count(*) AS n FROM cust
GROUP BY customer_id HAVING count(*) > 1
UNION ALL
SELECT 'email', email, count(*) FROM cust GROUP BY email HAVING count(*) > 1"""))
def _(star):
    return quality.dq_unique_keys(star.customer_documents(), ("customer_id", "email"))


#: The state of a customer's document is that of the customer's latest order before the sale's day.
@query("sales_as_of_customer", over("""
WITH versions AS (
SELECT o_custkey::varchar AS customer_id, o_orderdate::date AS valid_from,
       max(struct_pack(k := o_orderkey, p := o_orderpriority, t := o_totalprice)) AS v
FROM orders GROUP BY ALL)
SELECT transaction_id, s.customer_id, sale_date, v.p AS last_priority, v.t AS last_total
FROM (SELECT transaction_id, customer_id, sale_date FROM sales) s
ASOF LEFT JOIN versions ON s.customer_id = versions.customer_id AND s.sale_date > versions.valid_from"""))
def _(star):
    orders = star.table("orders").select(
        F.col("o_custkey").cast("string").alias("customer_id"), F.col("o_orderdate").cast("date").alias("valid_from"),
        "o_orderkey", F.col("o_orderpriority").alias("last_priority"), F.col("o_totalprice").alias("last_total"))
    return as_of_join(star.sales("transaction_id", "customer_id", "sale_date"), orders, "customer_id", "sale_date",
                      "valid_from", ["last_priority", "last_total"], strict=True, newest=["o_orderkey"])


@query("customers_of_spans", over("""
WITH spans AS (
SELECT 'month ' || strftime(sale_date, '%Y-%m') AS label, customer_id FROM sales UNION ALL
SELECT 'year ' || strftime(sale_date, '%Y'), customer_id FROM sales)
SELECT label, count(DISTINCT customer_id) AS customers, true AS within_bound FROM spans GROUP BY label"""))
def _(star):
    """Distinct customers of every month and year, exactly and from daily sketches; whether the
    sketches are within five standard errors."""
    sales = star.sales("customer_id", "sale_date")
    days = sales.groupBy("sale_date").agg(F.lit(1).alias("n"))
    label = F.explode(F.array(F.concat(F.lit("month "), F.date_format("sale_date", "yyyy-MM")),
                              F.concat(F.lit("year "), F.date_format("sale_date", "yyyy"))))
    spans = days.select(label.alias("label"), "sale_date").groupBy("label").agg(
        F.min("sale_date").alias("first_day"), F.max("sale_date").alias("last_day"))
    estimated = distinct_in_spans(daily_sketches(sales, "sale_date", "customer_id"), spans, name="estimate")
    exact = sales.distinct().select(label.alias("label"), "customer_id").groupBy("label").agg(
        F.count_distinct("customer_id").alias("customers"))
    off = F.abs(F.col("estimate") - F.col("customers")) <= F.ceil(5 * standard_error() * F.col("customers"))
    return exact.join(estimated, "label", "left").select("label", "customers", F.coalesce(off, F.lit(False)).alias("within_bound"))
