"""Customer analytics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.functions.bands import first_reached, points_at_least, points_at_most
from tallygrid.functions.dates import day, year_month
from tallygrid.functions.money import exact_deviation, exact_mean, exact_sum, ratio, rows
from tallygrid.operators.spread import attach

# The segment names the reports use.
SEGMENTS = ("Champions", "Loyal Customers", "Potential Loyalists", "New Customers")


def vip_customers(sales: DataFrame, min_purchases: int = 2,
                  key: str = "customer_name") -> DataFrame:
    """Customers with more than ``min_purchases`` purchases."""
    stats = sales.groupBy(key).agg(
        rows().alias("purchase_frequency"),
        exact_sum("total_amount").alias("total_spent"),
        exact_mean("total_amount").alias("avg_order_value"),
        F.sum("quantity").alias("total_items_bought"),
    )
    return stats.where(F.col("purchase_frequency") > min_purchases).orderBy(
        F.desc("total_spent"), key
    )


def _rfm_numbers(sales: DataFrame, key: str, as_of: dt.date | str | None) -> DataFrame:
    numbers = sales.groupBy(key).agg(
        F.max("sale_date").alias("last_purchase_date"),
        F.count("transaction_id").alias("frequency"),
        exact_sum("total_amount").alias("monetary_value"),
        exact_mean("total_amount").alias("avg_order_value"),
    )
    return numbers.withColumn("recency_days", F.datediff(day(as_of), "last_purchase_date"))


def customer_rfm(sales: DataFrame, as_of: dt.date | str | None = None,
                 recency: Sequence[float] = (7, 14), frequency: Sequence[float] = (3, 2),
                 monetary: Sequence[float] = (1000, 500), cuts: Sequence[float] = (8, 6, 4),
                 labels: Sequence[str] = SEGMENTS, key: str = "customer_name") -> DataFrame:
    """Recency, frequency and monetary value of every customer, each worth 1 to 3
    points, and the segment of the point total."""
    score = (
        points_at_most("recency_days", recency)
        + points_at_least("frequency", frequency)
        + points_at_least("monetary_value", monetary)
    )
    scored = _rfm_numbers(sales, key, as_of).withColumn("rfm_score", score)
    return scored.withColumn("customer_segment", first_reached("rfm_score", cuts, labels))


def rfm_segment_counts(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("customer_segment").count()


def mart_customer_segments(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy(F.col("customer_segment").alias("segment")).agg(
        rows().alias("count"),
        exact_mean("monetary_value").alias("avg_value"),
        exact_sum("monetary_value").alias("total_revenue"),
    )


def customer_cohort(sales: DataFrame, key: str = "customer_name",
                    visits: DataFrame | None = None) -> DataFrame:
    """Every sale with the month of the customer's first purchase and the months
    since then. The first purchase is a per-customer minimum joined back, so a
    customer with very many sales never has to fit one task.

    ``visits`` may give the key and date of the same sales from a cheaper source.
    """
    visits = sales if visits is None else visits
    first = visits.groupBy(key).agg(F.min("sale_date").alias("__first_sale"))
    return attach(sales, first, [key]).select(
        *sales.columns,
        year_month("__first_sale").alias("customer_cohort"),
        F.months_between("sale_date", "__first_sale").alias("period_number"),
    )


def customer_affinity(sales: DataFrame, key: str = "customer_name") -> DataFrame:
    """How often each customer bought each product, a row for each of the two, beside
    the customer's purchases in all (``product_count``, sales without a product not
    counted)."""
    bought = sales.groupBy(key, "product_name").agg(
        rows().alias("times_bought"), F.count("product_name").alias("__known"))
    totals = bought.groupBy(key).agg(F.sum("__known").alias("product_count"))
    return attach(bought.drop("__known"), totals, [key])


def customer_product_counts(sales: DataFrame, key: str = "customer_name") -> DataFrame:
    """``customer_affinity`` without the totals."""
    return customer_affinity(sales, key).drop("product_count")


def customer_features(sales: DataFrame, as_of: dt.date | str | None = None,
                      key: str = "customer_name") -> DataFrame:
    """Recency, frequency and monetary value of every customer, each shifted and
    scaled to mean 0 and sample deviation 1. Means and deviations are exact, so a
    customer's features do not depend on how sales are spread."""
    numbers = _rfm_numbers(sales, key, as_of)
    sources = {"r": "recency_days", "f": "frequency", "m": "monetary_value"}
    moments = numbers.agg(
        F.struct(
            *[exact_mean(c).alias(f"{name}_mean") for name, c in sources.items()],
            *[exact_deviation(c).alias(f"{name}_deviation") for name, c in sources.items()],
        )
    ).scalar()
    beside = numbers.withColumn("__all", moments)
    scaled = {
        name: ratio(F.col(c) - F.col(f"__all.{name}_mean"), F.col(f"__all.{name}_deviation"))
        for name, c in sources.items()
    }
    return beside.select(key, *[c.alias(name) for name, c in scaled.items()])


def customer_360(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales per customer next to the customer's document, matched or not."""
    bought = sales.groupBy("customer_id").agg(
        rows().alias("orders"), exact_sum("total_amount").alias("revenue")
    )
    known = customers.select("customer_id", "name", "loyalty_tier", F.lit(True).alias("found"))
    return bought.join(known, "customer_id", "left").select(
        "customer_id",
        "name",
        "loyalty_tier",
        "orders",
        "revenue",
        F.coalesce("found", F.lit(False)).alias("matched"),
    )


def customers_without_sales(sales: DataFrame, customers: DataFrame) -> DataFrame:
    buyers = sales.select("customer_id").distinct()
    return customers.join(buyers, "customer_id", "left_anti").select("customer_id")


def sales_without_customer(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Ids that appear in sales but have no customer document."""
    buyers = sales.select("customer_id").distinct()
    return buyers.join(customers, "customer_id", "left_anti")
