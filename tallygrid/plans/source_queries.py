"""Readers and writers: each query writes a logical table, reads it back, and
returns what was read."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrid.operators import documents, employees, report, sales
from tallygrid.operators.documents import doc_category_rollup, flat_sales
from tallygrid.plans.catalog import query
from tallygrid.plans.document_queries import FLAT, flat
from tallygrid.plans.oracle import int_mean, mean, over, total
from tallygrid.plans.sales_queries import COLUMNS
from tallygrid.sources import schemas, sinks, tables
from tallygrid.sources.scratch import fresh_folder


def round_trip(star, df, write, read, label):
    path = fresh_folder(star.spark, label)
    write(df, path)
    return read(star.spark, path)


@query("src_employees", over("SELECT * FROM employees"))
def _(star):
    return round_trip(star, star.employees(), sinks.write_with_header, tables.read_employees,
                      "employees")


@query("src_employees_positional", over("SELECT * FROM employees"))
def _(star):
    return round_trip(star, star.employees(), sinks.write_positional,
                      lambda s, p: tables.read_employees(s, p, header=False), "employees")


@query("src_sales", over(f"SELECT {COLUMNS} FROM sales"))
def _(star):
    return round_trip(star, star.sales(), sinks.write_with_header, tables.read_sales, "sales")


@query("src_sales_text", over(f"""
SELECT {COLUMNS.replace('sale_date', 'sale_date::varchar AS sale_date')} FROM sales"""))
def _(star):
    return round_trip(star, star.sales(), sinks.write_positional,
                      lambda s, p: tables.read_sales(s, p, header=False), "sales")


def all_strings(star):
    return round_trip(star, star.employees(), sinks.write_with_header, tables.read_all_strings,
                      "employees")


@query("src_all_string", over("""
SELECT id::varchar AS id, name, age::varchar AS age, city, salary::varchar AS salary, department,
       hire_date, status FROM employees"""))
def _(star):
    return all_strings(star)


@query("emp_department_headcount", over(f"""
SELECT department, count(*) AS count, {mean('salary')} AS avg_salary
FROM employees GROUP BY department"""))
def _(star):
    return employees.emp_department_headcount(all_strings(star))


@query("doc_sales_scan", over(f"SELECT {FLAT} FROM docs"))
def _(star):
    path = fresh_folder(star.spark, "documents")
    for piece in star.pieces():
        sinks.add_documents(piece.documents(), path)
    return flat(tables.read_collection(star.spark, path, schemas.SALES_DOCUMENT))


@query("doc_inferred_scan", over(f"""
SELECT category, count(*) AS total_transactions, {total('total_amount')} AS total_sales
FROM docs GROUP BY category"""))
def _(star):
    docs = star.documents("category", "total_amount")
    return doc_category_rollup(
        round_trip(star, docs, sinks.write_documents, tables.read_collection, "documents"))


@query("doc_flat_sales", over("""
SELECT transaction_id, category, quantity, unit_price, total_amount, customer_id, customer_name,
       sale_date, region, salesperson FROM docs"""))
def _(star):
    docs = round_trip(star, star.documents(), sinks.write_table,
                      lambda s, p: tables.read_collection(s, p, source="parquet"), "documents")
    return flat_sales(docs).drop("product_id", "product_name")


@query("map_double", over("SELECT quantity, quantity * 2 AS doubled FROM sales"))
def _(star):
    return tables.map_double(star.sales("quantity"), "quantity")


@query("collection_samples")
def _(star):
    return tables.collection_samples({
        "sales": star.documents(),
        "customers": star.customer_documents(),
    })


@query("preview", over(f"""
SELECT {COLUMNS} FROM sales ORDER BY transaction_id, total_amount, customer_id LIMIT 5"""))
def _(star):
    return tables.preview(star.sales(), order=("transaction_id", "total_amount", "customer_id"))


@query("sql_over_view", over(f"""
SELECT region, category, count(*) AS n, {total('total_amount')} AS revenue
FROM sales WHERE quantity > 10 GROUP BY region, category"""))
def _(star):
    tables.register({"sales": star.sales("region", "category", "quantity", "total_amount")})
    return star.spark.sql("""
        SELECT region, category, count(*) AS n,
               cast(sum(cast(total_amount AS decimal(18,2))) AS double) AS revenue
        FROM sales WHERE quantity > 10 GROUP BY region, category""")


@query("format_columns", over("""
WITH sized AS (
SELECT o_totalprice, o_orderkey, o_custkey::double * o_orderkey * 100000 AS s FROM orders)
SELECT printf('$%.2f', o_totalprice) AS plain_money,
       '$' || format('{:,.2f}', o_totalprice) AS grouped_money,
       format('{:,}', o_orderkey) AS grouped_number,
       CASE WHEN s < 1024 THEN printf('%.2f B', s)
            WHEN s / 1024 < 1024 THEN printf('%.2f KB', s / 1024)
            WHEN s / 1048576 < 1024 THEN printf('%.2f MB', s / 1048576)
            WHEN s / 1073741824 < 1024 THEN printf('%.2f GB', s / 1073741824)
            WHEN s / 1099511627776 < 1024 THEN printf('%.2f TB', s / 1099511627776)
            ELSE printf('%.2f PB', s / 1125899906842624) END AS byte_size
FROM sized"""))
def _(star):
    orders = star.table("orders").withColumn(
        "size", F.col("o_custkey").cast("double") * F.col("o_orderkey") * 100000)
    return report.format_columns(orders, "o_totalprice", "o_orderkey", "size")


def staff(star):
    return employees.emp_clean(star.employees())


@query("sink_positional", over(f"""
SELECT department, count(*) AS employee_count, {mean('salary')} AS avg_salary,
       min(salary) AS min_salary, max(salary) AS max_salary, {int_mean('age')} AS avg_age
FROM emp GROUP BY department"""))
def _(star):
    stats = employees.emp_department_stats(staff(star))
    return round_trip(star, stats, sinks.write_positional,
                      lambda s, p: tables.read_positional(s, p, stats.schema), "stats")


@query("sink_lines", over(f"""
SELECT 'Department: ' || department || ' | Employees: ' || count(*)
       || ' | Avg Salary: $' || round({mean('salary')})::bigint
       || ' | Avg Age: ' || round({int_mean('age')})::bigint AS report_line
FROM emp GROUP BY department"""))
def _(star):
    lines = employees.emp_department_report(staff(star))
    return round_trip(star, lines, sinks.write_lines,
                      lambda s, p: s.read.text(p).toDF("report_line"), "report")


@query("sink_header", over(f"""
SELECT region, {total('total_amount')} AS revenue, count(*) AS transactions
FROM sales GROUP BY region"""))
def _(star):
    stats = sales.mart_region_simple(star.sales("region", "total_amount"))
    return round_trip(star, stats, lambda d, p: sinks.write_with_header(d, p, one_file=True),
                      lambda s, p: tables.read_with_header(s, p, stats.schema), "regions")


@query("sink_sample", over("SELECT * FROM employees ORDER BY id LIMIT 5"))
def _(star):
    return round_trip(star, star.employees().orderBy("id"), sinks.write_sample,
                      tables.read_employees, "sample")


@query("sink_json", over(f"""
SELECT coalesce(region, 'Unknown') AS region, {total('coalesce(total_amount, 0)')} AS total_sales,
       count(*) AS transactions, {total('coalesce(total_amount, 0)')} / count(*) AS avg_transaction
FROM docs GROUP BY 1"""))
def _(star):
    stats = documents.doc_region_rollup(star.documents("region", "total_amount"))
    return round_trip(star, stats, sinks.write_documents,
                      lambda s, p: tables.read_collection(s, p, stats.schema), "regions")


@query("sink_partitioned", over("""
SELECT strftime(sale_date, '%Y-%m') AS year_month, region, total_amount FROM sales"""))
def _(star):
    enriched = sales.sales_enriched(star.sales("sale_date", "region", "total_amount", "quantity"))
    return round_trip(star, enriched.select("year_month", "region", "total_amount"),
                      lambda d, p: sinks.write_table(d, p, ["year_month"]),
                      lambda s, p: s.read.parquet(p), "sales")


def export_sql(text: str) -> str:
    """``text`` is the form of a text column, with ``{c}`` for its name."""
    product, category, region = (text.format(c=c) for c in ("product_name", "category", "region"))
    return over(f"""
SELECT transaction_id AS "Transaction ID", {product} AS "Product", {category} AS "Category",
       coalesce(total_amount, 0) AS "Amount", {region} AS "Region",
       strftime(sale_date, '%Y-%m-%d %H:%M:%S') AS "Date" FROM docs""")


def export(star):
    return documents.export_sales(star.documents(
        "product_name", "category", "total_amount", "region", "sale_date"))


@query("export_sales_csv", export_sql("coalesce({c}, '')"))
def _(star):
    out = export(star)
    return round_trip(star, out, sinks.write_with_header,
                      lambda s, p: tables.read_with_header(s, p, out.schema), "export")


@query("export_departments_csv", over(f"""
SELECT department AS "Department", count(*) AS "Employees", {mean('salary')} AS "Avg Salary",
       {total('salary')} AS "Total Salary" FROM emp GROUP BY department"""))
def _(star):
    out = employees.export_departments(staff(star))
    return round_trip(star, out, lambda d, p: sinks.write_with_header(d, p, one_file=True),
                      lambda s, p: tables.read_with_header(s, p, out.schema), "departments")


ODD_CELLS = {
    0: ("concat('  ', name, ' ')", "'  ' || name || ' '"),
    1: ("concat('\"', name, '\" said, \"\"')", "'\"' || name || '\" said, \"\"'"),
    2: (r"concat('\\', name, '\\')", r"'\' || name || '\'"),
    3: ("concat(name, char(10), ' next, line', char(10))", "name || chr(10) || ' next, line' || chr(10)"),
    4: ("''", "''"),
    5: ("cast(null as string)", "NULL"),
    6: ("' '", "' '"),
}


def odd_name(which: int) -> str:
    """The name in a form that comma text might spoil, by the employee's id."""
    cases = " ".join(f"WHEN {k} THEN {v[which]}" for k, v in ODD_CELLS.items())
    return f"CASE id % 8 {cases} ELSE name END"


@query("sink_odd_cells", over(f"SELECT id, {odd_name(1)} AS name, city, {odd_name(1)} AS note FROM employees"))
def _(star):
    out = star.employees().select("id", F.expr(odd_name(0)).alias("name"), "city", F.expr(odd_name(0)).alias("note"))
    return round_trip(star, out, sinks.write_with_header,
                      lambda s, p: tables.read_with_header(s, p, out.schema, line_breaks=True), "odd")


@query("sink_odd_positional", over(f"SELECT {odd_name(1)} AS name, id FROM employees"))
def _(star):
    out = star.employees().select(F.expr(odd_name(0)).alias("name"), "id")
    return round_trip(star, out, sinks.write_positional,
                      lambda s, p: tables.read_positional(s, p, out.schema, line_breaks=True), "odd")


@query("sink_collection", over(f"""
SELECT category, count(*) AS total_transactions, {total('total_amount')} AS total_sales
FROM docs GROUP BY category"""))
def _(star):
    """An aggregate of documents written back to a store, by the name of its format."""
    stats = doc_category_rollup(star.documents("category", "total_amount"))

    def write(df, path):
        for _ in range(2):  # the second replaces the first
            sinks.write_collection(df, "orc", {"compression": "zlib"}, path)

    return round_trip(star, stats, write, lambda s, p: tables.read_collection(s, p, source="orc"), "collection")


@query("doc_connector_scan", over(f"SELECT {FLAT} FROM docs"))
def _(star):
    """Documents through a format name and options, their schema taken from the store."""
    return flat(round_trip(
        star, star.documents(), lambda d, p: sinks.write_collection(d, "orc", {}, p),
        lambda s, p: tables.read_collection(s, p, source="orc", options={"mergeSchema": "false"}), "documents"))


@query("export_sales_json", export_sql("coalesce({c}, '')"))
def _(star):
    out = export(star)
    return round_trip(star, out, sinks.write_documents,
                      lambda s, p: tables.read_collection(s, p, out.schema), "export")
