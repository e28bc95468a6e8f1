from tallygrid.plans import jobs
from tallygrid.sources import sinks, tables
from tallygrid.sources.scratch import fresh_folder


def test_all_reports_from_files(spark, make_emp, make_sales, rows_of):
    base = fresh_folder(spark, "jobs")
    emp = make_emp(*[{"salary": 50000.0 + 1000 * i, "age": 25 + i} for i in range(12)], {"id": 0})
    sold = make_sales(*[{"customer_name": f"N{i % 3}", "total_amount": 700.0 * i} for i in range(10)])
    sinks.write_with_header(emp, f"{base}/emp", one_file=True)
    sinks.write_with_header(sold, f"{base}/sales", one_file=True)
    docs = spark.createDataFrame(
        [("T1", ("Kite", "Toys"), (2, 9.5), ("Asia",), None)],
        "transaction_id string, product struct<name: string, category: string>, "
        "sale_info struct<quantity: int, total_amount: double>, location struct<region: string>, "
        "sale_date timestamp")
    sinks.write_documents(docs, f"{base}/docs")
    jobs.main(["--employees", f"{base}/emp", "--sales", f"{base}/sales", "--out", f"{base}/out",
               "--documents", f"{base}/docs", "--as-of", "2024-03-31", "--one-file"])

    def text(path):
        return [r[0] for r in spark.read.text(f"{base}/out/{path}").collect()]

    assert text("basic/total_employees") == ["12"]
    assert text("basic/department_summary_report") == [
        "Department: Ops | Employees: 12 | Avg Salary: $55500 | Avg Age: 31"]
    assert text("basic/executive_sales_summary") == [
        "SALES EXECUTIVE REPORT | Total transactions: 10 | Revenue: $31500 | "
        "Average basket: $3150 | Units sold: 10"]
    assert len(text("basic/vip_customers")) == 3
    assert text("advanced/employee_performance")[0].startswith("department,performance_segment,")
    assert len(text("advanced/cohort_analysis")) == 11
    assert len(text("advanced/executive_summary")) == 10
    rollup = tables.read_collection(spark, f"{base}/out/documents/results")
    assert rows_of(rollup, "category", "total_transactions", "total_sales") == [("Toys", 1, 9.5)]
