"""All reports of one kind in one go, each written to a folder of its own.

    python -m tallygrid.plans.jobs --employees EMP.csv --sales SALES.csv --out FOLDER

Reports are only described until they are written; no table is counted or read
for its own sake.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping

from pyspark.sql import DataFrame

from tallygrid.operators import customers, documents, employees, report, sales
from tallygrid.session import input_bytes, session, sized_for
from tallygrid.sources import schemas, sinks, tables
from tallygrid.sources.scratch import fresh_folder

# The folder names of the reports.
TEXT_REPORTS = ("department_summary_report", "executive_sales_summary")


def workforce_reports(emp: DataFrame) -> dict[str, DataFrame]:
    return {
        "total_employees": employees.emp_total(emp),
        "department_statistics": employees.emp_department_stats(emp),
        "city_analysis": employees.emp_city_stats(emp),
        "age_group_analysis": employees.emp_age_groups(emp),
        "salary_bracket_analysis": employees.emp_salary_brackets(emp),
        "status_analysis": employees.emp_status(emp),
        "top_10_earners": employees.emp_top_earners(emp),
        "department_summary_report": employees.emp_department_report(emp),
        "data_anomalies": employees.emp_anomalies(emp),
    }


def sales_reports(sold: DataFrame) -> dict[str, DataFrame]:
    return {
        "sales_kpi_global": sales.sales_kpi_global(sold),
        "sales_by_category": sales.sales_by_category(sold),
        "sales_by_region": sales.sales_by_region(sold),
        "salesperson_performance": sales.salesperson_performance(sold),
        "daily_sales_trend": sales.sales_daily_trend(sold),
        "top_products": sales.top_products(sold),
        "vip_customers": customers.vip_customers(sold),
        "basket_analysis": sales.basket_analysis(sold),
        "executive_sales_summary": sales.sales_executive_line(sold),
        "sales_anomalies": sales.sales_anomalies(sold),
    }


def advanced_reports(emp: DataFrame, sold: DataFrame, as_of: str | None = None) -> dict[str, DataFrame]:
    judged = employees.emp_performance_segments(employees.emp_performance_windows(emp, as_of))
    enriched = sales.sales_enriched(sold)
    return {
        "employee_performance": employees.salary_trends(judged),
        "top_performers": employees.top_performers(judged),
        "customer_rfm_analysis": customers.customer_rfm(sold, as_of),
        "geographic_analysis": sales.geographic_analysis(sold),
        "cohort_analysis": customers.customer_cohort(enriched),
        "executive_summary": report.executive_summary(emp, sold),
    }


def document_reports(docs: DataFrame) -> dict[str, DataFrame]:
    return {
        "results": documents.doc_category_rollup(docs),
        "by_region": documents.doc_region_rollup(docs),
        "by_category": documents.doc_category_sales(docs),
        "export_sales": documents.export_sales(docs),
    }


def columnar(df: DataFrame, label: str) -> DataFrame:
    """The table as it stands, written to the shared scratch folder as Parquet."""
    path = fresh_folder(df.sparkSession, label)
    sinks.write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_reports(reports: Mapping[str, DataFrame], folder: str, header: bool,
                  one_file: bool = False) -> None:
    for name, df in reports.items():
        path = f"{folder.rstrip('/')}/{name}"
        if name in TEXT_REPORTS:
            sinks.write_lines(df, path, one_file)
        elif header:
            sinks.write_with_header(df, path, one_file)
        else:
            sinks.write_positional(df, path, one_file)


def main(arguments: list[str] | None = None) -> None:
    options = argparse.ArgumentParser(description="Write all workforce and sales reports.")
    options.add_argument("--employees", required=True, help="comma text with a header line")
    options.add_argument("--sales", required=True, help="comma text with a header line")
    options.add_argument("--documents", help="sales documents as JSON lines")
    options.add_argument("--out", required=True, help="folder for the reports")
    options.add_argument("--as-of", help="reference day, yyyy-MM-dd; today without it")
    options.add_argument("--one-file", action="store_true", help="one file per report")
    options.add_argument("--input-gb", type=int, help="input size to size shuffles by; that of the files without it")
    given = options.parse_args(arguments)

    spark = session("reports")
    paths = [p for p in (given.employees, given.sales, given.documents) if p]
    size = given.input_gb << 30 if given.input_gb else input_bytes(spark, *paths)
    for name, value in sized_for(size).items():
        spark.conf.set(name, value)
    # Text is parsed once for all reports, which then read only the columns they need.
    emp = columnar(employees.emp_clean(tables.read_employees(spark, given.employees)), "employees")
    text_sales = columnar(sales.sales_clean(tables.read_sales(spark, given.sales, header=False)), "text-sales")
    sold = columnar(tables.read_sales(spark, given.sales), "sales")
    plain, advanced = f"{given.out}/basic", f"{given.out}/advanced"
    write_reports(workforce_reports(emp), plain, False, given.one_file)
    write_reports(sales_reports(text_sales), plain, False, given.one_file)
    write_reports(advanced_reports(emp, sold, given.as_of), advanced, True, given.one_file)
    if given.documents:
        docs = tables.read_collection(spark, given.documents, schemas.SALES_DOCUMENT)
        for name, df in document_reports(docs).items():
            sinks.write_documents(df, f"{given.out}/documents/{name}", given.one_file)


if __name__ == "__main__":
    main()
