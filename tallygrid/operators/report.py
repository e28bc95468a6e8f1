"""The consolidated metrics report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.functions.money import exact_mean, exact_sum, rows
from tallygrid.functions.text import byte_size, dollars, grouped_dollars, grouped_integer
from tallygrid.operators.sales import distinct_count


def _as_rows(one_row: DataFrame, kind: str) -> DataFrame:
    lines = one_row.unpivot([], one_row.columns, "metric", "value")
    return lines.withColumn("type", F.lit(kind))


def executive_summary(emp: DataFrame, sales: DataFrame, approximate: bool = False) -> DataFrame:
    """Nine headline metrics as text rows, from one pass over each table. Exact distinct counts
    of two columns copy each row of the pass twice; ``approximate`` ones do not."""
    people = emp.agg(
        rows().cast("string").alias("Total Employees"),
        dollars(exact_mean("salary")).alias("Average Salary"),
        distinct_count("department", approximate).cast("string").alias("Departments"),
        distinct_count("city", approximate).cast("string").alias("Cities"),
    )
    trade = sales.agg(
        rows().cast("string").alias("Total Transactions"),
        dollars(exact_sum("total_amount")).alias("Total Revenue"),
        dollars(exact_mean("total_amount")).alias("Average Transaction"),
        distinct_count("customer_name", approximate).cast("string").alias("Unique Customers"),
        distinct_count("product_name", approximate).cast("string").alias("Unique Products"),
    )
    return _as_rows(people, "HR").unionByName(_as_rows(trade, "Sales"))


def format_columns(df: DataFrame, money: str, number: str, size: str) -> DataFrame:
    """The display forms of an amount, a count and a byte size."""
    return df.select(
        dollars(money).alias("plain_money"),
        grouped_dollars(money).alias("grouped_money"),
        grouped_integer(number).alias("grouped_number"),
        byte_size(size).alias("byte_size"),
    )
