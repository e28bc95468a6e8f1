"""Analytics over nested documents."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.functions.dates import day
from tallygrid.functions.money import exact_sum, ratio_or_zero, rows


def field(path: str, default=None) -> Column:
    """A nested field; a missing parent, a missing field and null all give the default."""
    c = F.col(path)
    return c if default is None else F.coalesce(c, F.lit(default))


def doc_category_rollup(docs: DataFrame) -> DataFrame:
    return docs.groupBy(field("product.category").alias("category")).agg(
        rows().alias("total_transactions"),
        exact_sum("sale_info.total_amount").alias("total_sales"),
    )


def doc_region_rollup(docs: DataFrame, unknown: str = "Unknown") -> DataFrame:
    amount = field("sale_info.total_amount", 0.0)
    stats = docs.groupBy(field("location.region", unknown).alias("region")).agg(
        exact_sum(amount).alias("total_sales"), rows().alias("transactions")
    )
    mean = ratio_or_zero("total_sales", "transactions")
    return stats.withColumn("avg_transaction", mean).orderBy(F.desc("total_sales"), "region")


def doc_category_sales(docs: DataFrame, unknown: str = "Unknown") -> DataFrame:
    amount = field("sale_info.total_amount", 0.0)
    stats = docs.groupBy(field("product.category", unknown).alias("category")).agg(
        exact_sum(amount).alias("total_sales"),
        rows().alias("transactions"),
        F.sum(field("sale_info.quantity", 0)).alias("total_quantity"),
    )
    mean = ratio_or_zero("total_sales", "total_quantity")
    return stats.withColumn("avg_price", mean).orderBy(F.desc("total_sales"), "category")


def doc_recent_sales(docs: DataFrame, as_of: dt.date | str | None = None, days: int = 30,
                     n: int = 20) -> DataFrame:
    """The newest documents of the last ``days`` days, equal days by id and then by content."""
    since = F.date_sub(day(as_of), days)
    return docs.where(F.col("sale_date") >= since).orderBy(
        F.desc("sale_date"), "_id", "sale_info.total_amount", "product.category", "location.region",
        "customer.id").limit(n)


def doc_top_customers(customers: DataFrame, n: int = 10) -> DataFrame:
    return customers.orderBy(F.desc("total_spent"), "customer_id").limit(n)


def export_sales(docs: DataFrame) -> DataFrame:
    """Flat rows under display headers, blanks and zeros for what is missing."""
    return docs.select(
        field("transaction_id", "").alias("Transaction ID"),
        field("product.name", "").alias("Product"),
        field("product.category", "").alias("Category"),
        field("sale_info.total_amount", 0.0).alias("Amount"),
        field("location.region", "").alias("Region"),
        F.coalesce(F.col("sale_date").cast("string"), F.lit("")).alias("Date"),
    )


def flat_sales(docs: DataFrame) -> DataFrame:
    """Documents in the shape of the flat sales table."""
    return docs.select(
        "transaction_id",
        F.col("product.id").alias("product_id"),
        F.col("product.name").alias("product_name"),
        F.col("product.category").alias("category"),
        F.col("sale_info.quantity").alias("quantity"),
        F.col("sale_info.unit_price").alias("unit_price"),
        F.col("sale_info.total_amount").alias("total_amount"),
        F.col("customer.id").alias("customer_id"),
        F.col("customer.name").alias("customer_name"),
        F.col("sale_date").cast("date").alias("sale_date"),
        F.col("location.region").alias("region"),
        F.col("sales_rep").alias("salesperson"),
    )


def variant_documents(lines: DataFrame, text: str = "value") -> DataFrame:
    """JSON text as ``doc``, a variant: no schema is declared or inferred, and a field keeps
    whatever type it has in each document. Text that is no JSON gives null."""
    return lines.select(F.try_parse_json(text).alias("doc"))


def variant_field(paths: Sequence[str], kind: str, doc: str = "doc") -> Column:
    """The first of ``paths`` that a document has, as ``kind``: numbers and text turn into one
    another where that can be done, and are null where not."""
    return F.coalesce(*(F.try_variant_get(F.col(doc), path, kind) for path in paths))


def doc_variant_rollup(docs: DataFrame, category: Sequence[str] = ("$.product.category", "$.item.kind"),
                       amount: Sequence[str] = ("$.sale_info.total_amount", "$.amount")) -> DataFrame:
    """``doc_category_rollup`` over documents of several shapes, in one scan: a category and
    an amount may stand at different places, the amount as a number or as text."""
    flat = docs.select(variant_field(category, "string").alias("category"),
                       variant_field(amount, "double").alias("amount"))
    return flat.groupBy("category").agg(rows().alias("total_transactions"), exact_sum("amount").alias("total_sales"))


def variant_schema(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """The schema of all documents together, as text: one row."""
    return docs.agg(F.schema_of_variant_agg(doc).alias("schema"))
