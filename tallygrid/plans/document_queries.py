"""Document queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrid.operators import documents as ops
from tallygrid.plans.catalog import query
from tallygrid.plans.oracle import over, total
from tallygrid.sources import tables

AS_OF = "2001-08-01"


@query("doc_category_rollup", over(f"""
SELECT category, count(*) AS total_transactions, {total('total_amount')} AS total_sales
FROM docs GROUP BY category"""))
def _(star):
    return ops.doc_category_rollup(star.documents("category", "total_amount"))


@query("doc_region_rollup", over(f"""
SELECT coalesce(region, 'Unknown') AS region, {total('coalesce(total_amount, 0)')} AS total_sales,
       count(*) AS transactions, {total('coalesce(total_amount, 0)')} / count(*) AS avg_transaction
FROM docs GROUP BY 1"""))
def _(star):
    return ops.doc_region_rollup(star.documents("region", "total_amount"))


@query("doc_category_sales", over(f"""
SELECT coalesce(category, 'Unknown') AS category,
       {total('coalesce(total_amount, 0)')} AS total_sales, count(*) AS transactions,
       sum(coalesce(quantity, 0))::bigint AS total_quantity,
       CASE WHEN sum(quantity) > 0
            THEN {total('coalesce(total_amount, 0)')} / sum(coalesce(quantity, 0))
            ELSE 0 END AS avg_price
FROM docs GROUP BY 1"""))
def _(star):
    return ops.doc_category_sales(star.documents("category", "total_amount", "quantity"))


def flat(df):
    return df.select(
        "_id",
        "transaction_id",
        F.col("product.category").alias("category"),
        F.col("sale_info.total_amount").alias("total_amount"),
        F.col("location.region").alias("region"),
        F.col("customer.id").alias("customer_id"),
        F.col("sale_date").cast("date").alias("sale_date"),
    )


FLAT = "_id, transaction_id, category, total_amount, region, customer_id, sale_date"
FLAT_COLUMNS = ("category", "total_amount", "region", "sale_date", "customer_id")


@query("doc_recent_sales", over(f"""
SELECT {FLAT} FROM docs WHERE sale_date >= date '{AS_OF}' - 30
ORDER BY sale_date DESC, _id, total_amount NULLS FIRST, category NULLS FIRST,
         region NULLS FIRST, customer_id NULLS FIRST LIMIT 20"""))
def _(star):
    return flat(ops.doc_recent_sales(star.documents(*FLAT_COLUMNS), as_of=AS_OF))


@query("doc_find", over(f"""
SELECT {FLAT} FROM docs WHERE region = 'ASIA' AND total_amount > 50000"""))
def _(star):
    wanted = (F.col("location.region") == "ASIA") & (F.col("sale_info.total_amount") > 50000)
    return flat(tables.find(star.documents(*FLAT_COLUMNS), wanted))


@query("doc_top_customers", over("""
SELECT customer_id, name, email, loyalty_tier, total_orders, total_spent
FROM cust ORDER BY total_spent DESC, customer_id LIMIT 10"""))
def _(star):
    return ops.doc_top_customers(star.customer_documents()).select(
        "customer_id", "name", "email", "loyalty_tier", "total_orders", "total_spent")


@query("collection_profile", over("""
SELECT 'sales' AS collection, count(*) AS count FROM docs
UNION ALL SELECT 'customers', count(*) FROM cust
UNION ALL SELECT 'employees', count(*) FROM employees"""))
def _(star):
    return tables.collection_profile({
        "sales": star.documents("transaction_id"),
        "customers": star.customer_documents(),
        "employees": star.employees(),
    })


@query("export_sales", over("""
SELECT transaction_id AS "Transaction ID", coalesce(product_name, '') AS "Product",
       coalesce(category, '') AS "Category", coalesce(total_amount, 0) AS "Amount",
       coalesce(region, '') AS "Region",
       strftime(sale_date, '%Y-%m-%d %H:%M:%S') AS "Date"
FROM docs"""))
def _(star):
    return ops.export_sales(star.documents(
        "product_name", "category", "total_amount", "region", "sale_date"))


def two_shapes(star):
    """The documents as JSON text: the later half by order key has other names, and its
    amounts are text."""
    amount = F.when(F.col("l_orderkey") % 19 != 0, F.col("l_extendedprice"))
    named = star.table("lineitem").join(star.table("part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    kind = F.when(F.col("l_partkey") % 17 != 0, F.col("p_type"))
    early = F.to_json(F.struct(F.struct(kind.alias("category")).alias("product"),
                               F.struct(amount.alias("total_amount")).alias("sale_info")))
    late = F.to_json(F.struct(F.struct(kind.alias("kind")).alias("item"),
                              F.format_string("%.2f", amount).alias("amount"),
                              F.array(F.col("l_linenumber")).alias("lines")))
    text = F.when(F.col("l_orderkey") % 2 == 0, early).otherwise(late)
    return named.select(F.when(amount.isNull() & (F.col("l_orderkey") % 2 == 1), F.to_json(F.struct(
        F.struct(kind.alias("kind")).alias("item")))).otherwise(text).alias("value"))


@query("doc_variant_rollup", over(f"""
SELECT category, count(*) AS total_transactions, {total('total_amount')} AS total_sales
FROM docs GROUP BY category"""))
def _(star):
    return ops.doc_variant_rollup(ops.variant_documents(two_shapes(star)))


@query("doc_variant_fields", over("""
SELECT field, n FROM (
  SELECT count(*) FILTER (WHERE l_orderkey % 2 = 0 AND total_amount IS NOT NULL) AS number,
         count(*) FILTER (WHERE l_orderkey % 2 = 1 AND total_amount IS NOT NULL) AS text,
         count(*) FILTER (WHERE total_amount IS NULL) AS missing
  FROM (SELECT l_orderkey, CASE WHEN l_orderkey % 19 <> 0 THEN total_amount END AS total_amount FROM sales))
UNPIVOT (n FOR field IN (number, text, missing))"""))
def _(star):
    """How the documents hold their amount."""
    docs = ops.variant_documents(two_shapes(star))
    number = F.try_variant_get("doc", "$.sale_info.total_amount", "double").isNotNull()
    text = F.try_variant_get("doc", "$.amount", "string").isNotNull()
    counts = docs.agg(F.count_if(number).alias("number"), F.count_if(text).alias("text"),
                      F.count_if(~number & ~text).alias("missing"))
    return counts.unpivot([], ["number", "text", "missing"], "field", "n")
