"""Sales analytics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.functions.dates import weekday_name, year_month
from tallygrid.functions.money import (
    exact_mean,
    exact_sum,
    exact_total,
    other_total,
    put_together,
    ratio,
    rows,
)
from tallygrid.functions.text import whole_text
from tallygrid.operators.distinct import distinct_bitmaps, distinct_by_grouping, distinct_in_unions
from tallygrid.operators.spread import attach, standings

# The labels the reports use.
BASKET_LABELS = ("Single Item", "Small Basket (2 items)", "Large Basket (3+ items)")
EXECUTIVE_TITLE = "SALES EXECUTIVE REPORT"
EXECUTIVE_LABELS = (
    "Total transactions: ",
    "Revenue: $",
    "Average basket: $",
    "Units sold: ",
)


def distinct_count(c: str, approximate: bool) -> Column:
    """Exact, or from a sketch whose size does not grow with the data."""
    return F.approx_count_distinct(c) if approximate else F.count_distinct(c)


def sales_clean(df: DataFrame) -> DataFrame:
    """Drops header lines read as data, and rows without a transaction id."""
    return df.where(F.col("transaction_id") != "transaction_id")


def sales_date_parts(sales: DataFrame) -> DataFrame:
    """Month and day cut from the date's text form."""
    text = F.col("sale_date").cast("string")
    day_text = F.substring(text, 9, 2)
    return sales.withColumns(
        {
            "year_month": F.substring(text, 1, 7),
            "day": day_text,
            "day_of_month": day_text.try_cast("int"),
        }
    )


def sales_kpi_global(sales: DataFrame, approximate: bool = False) -> DataFrame:
    return sales.agg(
        rows().alias("total_transactions"),
        exact_sum("total_amount").alias("total_revenue"),
        exact_mean("total_amount").alias("avg_transaction_value"),
        F.sum("quantity").alias("total_units_sold"),
        distinct_count("customer_id", approximate).alias("unique_customers"),
    )


def sales_by_category(sales: DataFrame) -> DataFrame:
    stats = sales.groupBy("category").agg(
        rows().alias("transaction_count"),
        exact_sum("total_amount").alias("total_revenue"),
        exact_mean("total_amount").alias("avg_transaction_value"),
        F.sum("quantity").alias("total_quantity"),
        exact_mean("unit_price").alias("avg_unit_price"),
    )
    return stats.orderBy(F.desc("total_revenue"), "category")


def sales_by_region(sales: DataFrame, approximate: bool = False) -> DataFrame:
    stats = sales.groupBy("region").agg(
        rows().alias("transactions"),
        exact_sum("total_amount").alias("revenue"),
        exact_mean("total_amount").alias("avg_order_value"),
        distinct_count("customer_id", approximate).alias("unique_customers"),
    )
    per_customer = ratio("revenue", "unique_customers")
    return stats.withColumn("revenue_per_customer", per_customer).orderBy(
        F.desc("revenue"), "region"
    )


def salesperson_performance(sales: DataFrame, approximate: bool = False) -> DataFrame:
    stats = sales.groupBy("salesperson").agg(
        rows().alias("total_sales"),
        exact_sum("total_amount").alias("total_revenue"),
        exact_mean("total_amount").alias("avg_sale_amount"),
        distinct_count("customer_id", approximate).alias("customers_served"),
    )
    return stats.orderBy(F.desc("total_revenue"), "salesperson")


def sales_daily_trend(sales: DataFrame) -> DataFrame:
    stats = sales.groupBy("sale_date").agg(
        rows().alias("daily_transactions"),
        exact_sum("total_amount").alias("daily_revenue"),
        exact_mean("total_amount").alias("avg_daily_transaction"),
    )
    return stats.orderBy("sale_date")


def top_products(sales: DataFrame, n: int = 10) -> DataFrame:
    stats = sales.groupBy("product_name").agg(
        rows().alias("times_sold"),
        F.sum("quantity").alias("total_quantity_sold"),
        exact_sum("total_amount").alias("total_product_revenue"),
        exact_mean("unit_price").alias("avg_unit_price"),
    )
    return stats.orderBy(F.desc("total_product_revenue"), "product_name").limit(n)


def basket_analysis(sales: DataFrame, edges: tuple[int, int] = (1, 2),
                    labels: Sequence[str] = BASKET_LABELS) -> DataFrame:
    """Sales by basket size: exactly the first edge, up to the second, beyond it.
    The share is a window over these three groups."""
    units = F.col("quantity")
    basket = (
        F.when(units.isNull(), F.lit(None).cast("string"))
        .when(units == edges[0], labels[0])
        .when(units <= edges[1], labels[1])
        .otherwise(labels[2])
    )
    stats = sales.groupBy(basket.alias("basket_size")).agg(
        rows().alias("transaction_count"),
        exact_sum("total_amount").alias("revenue_contribution"),
        exact_mean("total_amount").alias("avg_transaction_value"),
        exact_total("total_amount").alias("exact"),
        other_total("total_amount").alias("other"),
    )
    everyone = Window.partitionBy()
    everything = put_together(F.sum("exact").over(everyone), F.sum("other").over(everyone))
    share = ratio(F.col("revenue_contribution") * 100.0, everything)
    return stats.withColumn("revenue_percentage", share).drop("exact", "other")


def sales_executive_line(sales: DataFrame, title: str = EXECUTIVE_TITLE,
                         labels: Sequence[str] = EXECUTIVE_LABELS) -> DataFrame:
    """The headline numbers as one line of text."""
    numbers = sales.agg(
        rows().cast("string").alias("transactions"),
        whole_text(exact_sum("total_amount")).alias("revenue"),
        whole_text(exact_mean("total_amount")).alias("basket"),
        F.sum("quantity").cast("string").alias("units"),
    )
    pieces = [F.lit(title)]
    for label, c in zip(labels, numbers.columns):
        pieces += [F.lit(f" | {label}"), F.col(c)]
    return numbers.select(F.concat(*pieces).alias("executive_line"))


def is_anomaly(max_amount: float = 2000, max_quantity: int = 5,
               max_price: float = 1500) -> Column:
    return (
        (F.col("total_amount") > max_amount)
        | (F.col("quantity") > max_quantity)
        | (F.col("unit_price") > max_price)
    )


def sales_anomaly_summary(sales: DataFrame, max_amount: float = 2000, max_quantity: int = 5,
                          max_price: float = 1500) -> DataFrame:
    odd = sales.where(is_anomaly(max_amount, max_quantity, max_price))
    return odd.agg(
        rows().alias("anomaly_count"), exact_sum("total_amount").alias("anomaly_revenue")
    )


def sales_anomalies(sales: DataFrame, max_amount: float = 2000, max_quantity: int = 5,
                    max_price: float = 1500, tag: str = "HIGH_VALUE") -> DataFrame:
    odd = sales.where(is_anomaly(max_amount, max_quantity, max_price))
    return odd.select(
        "transaction_id",
        "product_name",
        "quantity",
        "unit_price",
        "total_amount",
        "customer_name",
        F.lit(tag).alias("anomaly_type"),
    )


def sales_enriched(sales: DataFrame, margin_rate: float = 0.3) -> DataFrame:
    return sales.withColumns(
        {
            "year_month": year_month("sale_date"),
            "day_of_week": weekday_name("sale_date"),
            "profit_margin": F.col("total_amount") * F.lit(float(margin_rate)),
            "revenue_per_unit": ratio("total_amount", "quantity"),
        }
    )


def sales_running_total(sales: DataFrame, amounts: DataFrame | None = None) -> DataFrame:
    """Every sale with the revenue of all sales up to and including its day.

    Sales are summed per day, the days are cumulated, and the result is joined
    back. There are at most 3.7 million days between the years 1 and 9999, so
    one task can order them and every task can hold them. ``amounts`` may give the
    date and amount of the same sales from a cheaper source.
    """
    amounts = sales if amounts is None else amounts
    day_key = F.col("sale_date").try_cast("date")
    per_day = amounts.groupBy(day_key.alias("__day")).agg(
        exact_total("total_amount").alias("__t"), other_total("total_amount").alias("__o"))
    up_to = Window.orderBy("__day").rowsBetween(Window.unboundedPreceding, 0)
    total = put_together(F.sum("__t").over(up_to), F.sum("__o").over(up_to))
    so_far = per_day.select("__day", total.alias("running_total"))
    return sales.join(
        F.broadcast(so_far), day_key.eqNullSafe(F.col("__day")), "left"
    ).drop("__day")


def sales_daily_rank(sales: DataFrame, slots_per_octave: int = 128,
                     amounts: DataFrame | None = None) -> DataFrame:
    """Every sale with its rank by amount, highest first, within its day.
    ``amounts`` may give the date and amount of the same sales from a cheaper source."""
    amounts = sales if amounts is None else amounts
    standing = standings(amounts, "sale_date", "total_amount", slots_per_octave)
    ranked = attach(sales, standing, ["sale_date", "total_amount"])
    above = F.col("__group_n") - F.col("__below") - F.col("__n")
    return ranked.select(*sales.columns, (above + 1).alias("daily_rank"))


def geographic_analysis(sales: DataFrame, key: str = "customer_name",
                        approximate: bool = False) -> DataFrame:
    """Revenue by region and category, its share of the region, and the region's
    rank within the category. The windows run over the aggregate only."""
    cells = sales.groupBy("region", "category").agg(
        exact_total("total_amount").alias("exact"),
        other_total("total_amount").alias("other"),
        rows().alias("transactions"),
        distinct_count(key, approximate).alias("unique_customers"),
        exact_mean("total_amount").alias("avg_transaction"),
    )
    region = Window.partitionBy("region")
    in_region = put_together(F.sum("exact").over(region), F.sum("other").over(region))
    within = Window.partitionBy("category").orderBy(F.desc("revenue"))
    cells = cells.withColumn("revenue", put_together("exact", "other"))
    return cells.select(
        "region",
        "category",
        "revenue",
        "transactions",
        "unique_customers",
        "avg_transaction",
        ratio("revenue", in_region).alias("market_share"),
        F.rank().over(within).alias("region_rank"),
    )


def _region_category_cells(sales: DataFrame) -> DataFrame:
    return sales.groupBy("region", "category").agg(
        exact_total("total_amount").alias("exact"),
        other_total("total_amount").alias("other"),
        rows().alias("cell_rows"),
    )


def _grouping_totals(grouped) -> DataFrame:
    return grouped.agg(
        F.grouping_id().alias("gid"),
        put_together(F.sum("exact"), F.sum("other")).alias("revenue"),
        F.sum("cell_rows").alias("n"),
    ).select("region", "category", "gid", "revenue", "n")


def sales_cube(sales: DataFrame) -> DataFrame:
    """Totals over every combination of region and category, taken from the
    region x category cells so that only those few rows are multiplied."""
    return _grouping_totals(_region_category_cells(sales).cube("region", "category"))


def sales_rollup(sales: DataFrame) -> DataFrame:
    return _grouping_totals(_region_category_cells(sales).rollup("region", "category"))


def _grouping_customers(sales: DataFrame, kind: str, key: str) -> DataFrame:
    """Cube or roll-up of region and category, with the exact number of distinct customers
    of every grouping. Sales are grouped by cell, once for totals and once for bitmaps of
    the customers; only these cells are multiplied."""
    cells = ["region", "category"]
    totals = sales_cube(sales) if kind == "cube" else sales_rollup(sales)
    customers = distinct_by_grouping(distinct_bitmaps(sales, cells, key), cells, kind, "customers")
    counted = attach(totals, customers, [*cells, "gid"])
    return counted.select(*cells, "gid", "revenue", "n", F.coalesce("customers", F.lit(0)).alias("customers"))


def sales_cube_customers(sales: DataFrame, key: str = "customer_id") -> DataFrame:
    return _grouping_customers(sales, "cube", key)


def sales_rollup_customers(sales: DataFrame, key: str = "customer_id") -> DataFrame:
    return _grouping_customers(sales, "rollup", key)


def market_customers(sales: DataFrame, markets: DataFrame, key: str = "customer_id") -> DataFrame:
    """Distinct customers of each market: ``markets`` names the cells (region, category) that
    belong to it. A customer of two cells of a market counts once."""
    cells = ["region", "category"]
    return distinct_in_unions(distinct_bitmaps(sales, cells, key), cells, markets, "market", "customers")


def mart_region(sales: DataFrame, approximate: bool = False) -> DataFrame:
    return sales.groupBy("region").agg(
        exact_sum("total_amount").alias("revenue"),
        distinct_count("customer_id", approximate).alias("customers"),
        exact_mean("total_amount").alias("avg_order"),
    )


def mart_region_simple(sales: DataFrame) -> DataFrame:
    return sales.groupBy("region").agg(
        exact_sum("total_amount").alias("revenue"), rows().alias("transactions")
    )


def mart_product(sales: DataFrame, margin_rate: float = 0.3,
                 rates: Mapping[str, float] | None = None) -> DataFrame:
    """Revenue, units and margin percent of every product. ``rates`` gives
    categories a margin of their own; the others keep ``margin_rate``."""
    rate = F.lit(float(margin_rate))
    for category, special in (rates or {}).items():
        rate = F.when(F.col("category") == category, F.lit(float(special))).otherwise(rate)
    earned = exact_sum(F.col("total_amount") * rate)
    revenue = exact_sum("total_amount")
    return sales.groupBy(F.col("product_name").alias("product")).agg(
        revenue.alias("sales"),
        F.sum("quantity").alias("units"),
        F.round(ratio(earned, revenue) * 100.0, 6).alias("margin"),
    )
