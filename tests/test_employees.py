import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallygrid.operators import employees as emp


def test_clean_drops_missing_and_non_positive_ids(make_emp, rows_of):
    df = make_emp({"id": None}, {"id": 0}, {"id": -4}, {"id": 9})
    assert rows_of(emp.emp_clean(df), "id") == [(9,)]


def test_department_stats(make_emp, rows_of):
    df = make_emp({"salary": 10.0, "age": 20}, {"salary": 20.0, "age": 31},
                  {"department": "HR", "salary": None, "age": None})
    assert rows_of(emp.emp_department_stats(df)) == [
        ("HR", 1, None, None, None, None), ("Ops", 2, 15.0, 10.0, 20.0, 25.5)]


def test_city_stats_keep_only_larger_cities(make_emp, rows_of):
    df = make_emp({}, {}, {"city": "Oslo"})
    assert rows_of(emp.emp_city_stats(df)) == [("Rome", 2, 50000.0)]


def test_bands_with_null_age_and_salary(make_emp, rows_of):
    ages = make_emp(*[{"age": a} for a in (29, 30, 39, 40, None)])
    assert rows_of(emp.emp_age_groups(ages), "age_group", "count") == [
        ("Middle (30-39)", 2), ("Senior (40+)", 1), ("Young (< 30)", 1), (None, 1)]
    pays = make_emp(*[{"salary": s} for s in (59999.99, 60000.0, 79999.99, 80000.0, None)])
    assert rows_of(emp.emp_salary_brackets(pays), "salary_bracket", "count") == [
        ("High (80K+)", 1), ("Low (< 60K)", 1), ("Medium (60K-80K)", 2), (None, 1)]


def test_status_share_uses_the_real_count(make_emp, rows_of):
    df = make_emp({}, {}, {}, {"status": "Inactive"})
    assert rows_of(emp.emp_status(df), "status", "percentage") == [
        ("Active", 75.0), ("Inactive", 25.0)]


def test_top_earners_order(make_emp):
    df = make_emp({"salary": 1.0}, {"salary": 3.0}, {"salary": 2.0}, {"salary": 3.0, "name": "A0"})
    assert [r["name"] for r in emp.emp_top_earners(df, 3).collect()] == ["A0", "N2", "N3"]


def test_report_line(make_emp, rows_of):
    df = make_emp({"salary": 80230.5, "age": 36}, {"salary": 80230.5, "age": 37})
    assert rows_of(emp.emp_department_report(df)) == [
        ("Department: Ops | Employees: 2 | Avg Salary: $80231 | Avg Age: 37",)]


def test_anomaly_edges(make_emp):
    df = make_emp(*[{"salary": s} for s in (9999.0, 10000.0, 200000.0, 200001.0)],
                  *[{"age": a} for a in (17, 18, 70, 71)])
    assert emp.emp_anomaly_count(df).first()[0] == 4
    assert {r["id"] for r in emp.emp_anomalies(df).collect()} == {1, 4, 5, 8}


def test_empty_table(make_emp):
    nobody = make_emp({}).where("id < 0")
    assert emp.emp_total(nobody).first()[0] == 0
    assert emp.emp_status(nobody).count() == 0
    assert emp.emp_performance_windows(nobody, "2024-01-01").count() == 0


def test_headcount_from_text_columns(spark, rows_of):
    df = spark.createDataFrame([("Ops", "10.5"), ("Ops", "x"), ("Ops", "11.5")],
                               "department string, salary string")
    assert rows_of(emp.emp_department_headcount(df)) == [("Ops", 3, 11.0)]


def naive_windows(df, as_of):
    dept = Window.partitionBy("department")
    return df.select(
        "id",
        F.round(F.avg("salary").over(dept), 6).alias("dept_avg_salary"),
        F.rank().over(dept.orderBy(F.desc("salary"))).cast("bigint").alias("salary_rank"),
        F.percent_rank().over(dept.orderBy("salary")).alias("salary_percentile"),
    )


@pytest.mark.parametrize("slots_per_octave", [128, 1, 5000])
def test_performance_windows_equal_plain_windows(spark, make_emp, rows_of, slots_per_octave):
    changes = []
    for i in range(400):
        pay = None if i % 31 == 0 else float((i * 7919) % 97) * 250 - 3000.5
        changes.append({"salary": pay, "department": None if i % 29 == 0 else f"D{(i * i) % 4}"})
    changes.append({"department": "Alone", "salary": 5.0})
    df = make_emp(*changes)
    got = emp.emp_performance_windows(df, "2024-08-31", slots_per_octave=slots_per_octave)
    got = got.withColumn("dept_avg_salary", F.round("dept_avg_salary", 6))
    columns = ("id", "dept_avg_salary", "salary_rank", "salary_percentile")
    assert rows_of(got, *columns) == rows_of(naive_windows(df, "2024-08-31"), *columns)


def test_tenure_and_above_average(make_emp, rows_of):
    df = make_emp({"hire_date": "2020-08-31", "salary": 10.0},
                  {"hire_date": "soon", "salary": 30.0})
    got = emp.emp_performance_windows(df, "2024-08-31")
    assert rows_of(got, "id", "years_service", "salary_above_dept_avg") == [
        (1, 1461 / 365.25, False), (2, None, True)]


def test_segments(make_emp, rows_of):
    df = make_emp(*[{"salary": float(s), "hire_date": h} for s, h in [
        (1, "2010-01-01"), (2, "2010-01-01"), (3, "2010-01-01"), (4, "2010-01-01"),
        (5, "2010-01-01"), (6, "2022-07-01"), (7, "2024-01-01"), (8, "bad"), (9, "2010-01-01"),
        (10, "2021-01-01"), (11, "2022-07-01")]])
    got = emp.emp_performance_segments(emp.emp_performance_windows(df, "2024-08-31"))
    assert [s for _, s in sorted(rows_of(got, "id", "performance_segment"))] == [
        "Developing"] * 4 + ["Average Performer"] * 2 + [
        "Average Performer", "Average Performer", "High Performer", "High Performer",
        "Good Performer"]


def test_trends_of_one_person_have_no_deviation(make_emp, rows_of):
    df = emp.emp_performance_segments(emp.emp_performance_windows(make_emp({}), "2024-01-01"))
    assert rows_of(emp.salary_trends(df), "employee_count", "salary_std", "active_employees") == [
        (1, None, 1)]


def test_department_mart_shares(make_emp, rows_of):
    df = make_emp({"salary": 100.0}, {"salary": 200.0}, {"department": "HR", "salary": 100.0})
    assert rows_of(emp.mart_department(df)) == [
        ("HR", 1, 100.0, 100.0, 25.0), ("Ops", 2, 150.0, 300.0, 75.0)]
    assert emp.export_departments(df).columns == [
        "Department", "Employees", "Avg Salary", "Total Salary"]


def test_signed_zero_and_extreme_salaries_rank_like_plain_windows(make_emp, rows_of):
    df = make_emp(*[{"salary": s} for s in (-0.0, 0.0, 5.0, -5.0, None, 0.0, 1e9, -1e9)])
    columns = ("id", "salary_rank", "salary_percentile")
    got = emp.emp_performance_windows(df, "2024-08-31")
    assert rows_of(got, *columns) == rows_of(naive_windows(df, "2024-08-31"), *columns)
