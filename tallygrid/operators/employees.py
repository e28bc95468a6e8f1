"""Workforce analytics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.functions.bands import below_bands
from tallygrid.functions.dates import DAYS_PER_YEAR, day, parsed_date, years_between
from tallygrid.functions.money import exact_deviation, exact_mean, exact_sum, int_mean, ratio, rows
from tallygrid.functions.text import whole_text
from tallygrid.operators.spread import attach, standings

# The labels the reports use.
AGE_LABELS = ("Young (< 30)", "Middle (30-39)", "Senior (40+)")
SALARY_LABELS = ("Low (< 60K)", "Medium (60K-80K)", "High (80K+)")
SEGMENTS = ("High Performer", "Good Performer", "Average Performer", "Developing")
REPORT_LABELS = ("Department: ", "Employees: ", "Avg Salary: $", "Avg Age: ")


def emp_clean(df: DataFrame) -> DataFrame:
    """Rows with a positive id; header lines read as data have none."""
    return df.where(F.col("id") > 0)


def emp_total(emp: DataFrame) -> DataFrame:
    return emp.agg(rows().alias("total_count"))


def emp_department_stats(emp: DataFrame) -> DataFrame:
    stats = emp.groupBy("department").agg(
        rows().alias("employee_count"),
        exact_mean("salary").alias("avg_salary"),
        F.min("salary").alias("min_salary"),
        F.max("salary").alias("max_salary"),
        int_mean("age").alias("avg_age"),
    )
    return stats.orderBy(F.desc("employee_count"), "department")


def emp_city_stats(emp: DataFrame, min_count: int = 1) -> DataFrame:
    """Cities with more than ``min_count`` employees."""
    stats = emp.groupBy("city").agg(
        rows().alias("employee_count"), exact_mean("salary").alias("avg_salary_city")
    )
    return stats.where(F.col("employee_count") > min_count).orderBy(
        F.desc("employee_count"), "city"
    )


def _band_stats(emp: DataFrame, source: str, edges: Sequence[float], labels: Sequence[str],
                name: str) -> DataFrame:
    return emp.groupBy(below_bands(source, edges, labels).alias(name)).agg(
        rows().alias("count"),
        exact_mean("salary").alias("avg_salary"),
        int_mean("age").alias("avg_age"),
    )


def emp_age_groups(emp: DataFrame, edges: Sequence[float] = (30, 40),
                   labels: Sequence[str] = AGE_LABELS) -> DataFrame:
    return _band_stats(emp, "age", edges, labels, "age_group").orderBy("avg_age", "age_group")


def emp_salary_brackets(emp: DataFrame, edges: Sequence[float] = (60000, 80000),
                        labels: Sequence[str] = SALARY_LABELS) -> DataFrame:
    return _band_stats(emp, "salary", edges, labels, "salary_bracket")


def emp_status(emp: DataFrame) -> DataFrame:
    """Per status, with its share of all employees (a window over the few groups)."""
    stats = emp.groupBy("status").agg(
        rows().alias("count"), exact_mean("salary").alias("avg_salary")
    )
    everyone = F.sum("count").over(Window.partitionBy())
    return stats.withColumn("percentage", ratio(F.col("count") * 100.0, everyone))


def emp_top_earners(emp: DataFrame, n: int = 10) -> DataFrame:
    best = emp.orderBy(F.desc("salary"), "name", "id").limit(n)
    return best.select("name", "department", "city", "salary", "age")


def emp_department_report(emp: DataFrame, labels: Sequence[str] = REPORT_LABELS) -> DataFrame:
    """One text line per department."""
    numbers = emp.groupBy("department").agg(
        rows().cast("string").alias("head_count"),
        whole_text(exact_mean("salary")).alias("salary_mean"),
        whole_text(int_mean("age")).alias("age_mean"),
    )
    pieces = []
    for label, c in zip(labels, ("department", "head_count", "salary_mean", "age_mean")):
        pieces += [F.lit(label if not pieces else f" | {label}"), F.col(c)]
    return numbers.select(F.concat(*pieces).alias("report_line"))


def emp_anomalies(emp: DataFrame, salary: tuple[float, float] = (10000, 200000),
                  age: tuple[int, int] = (18, 70)) -> DataFrame:
    """Employees whose salary or age lies outside the given ranges."""
    odd_salary = (F.col("salary") < salary[0]) | (F.col("salary") > salary[1])
    odd_age = (F.col("age") < age[0]) | (F.col("age") > age[1])
    return emp.where(odd_salary | odd_age)


def emp_anomaly_count(emp: DataFrame, salary: tuple[float, float] = (10000, 200000),
                      age: tuple[int, int] = (18, 70)) -> DataFrame:
    return emp_anomalies(emp, salary, age).agg(rows().alias("anomaly_count"))


def emp_department_headcount(emp: DataFrame) -> DataFrame:
    """Headcount and mean salary; works on columns read as text too."""
    pay = F.col("salary").try_cast("double")
    stats = emp.groupBy("department").agg(rows().alias("count"), exact_mean(pay).alias("avg_salary"))
    return stats.orderBy(F.desc("count"), "department")


def emp_department_count(emp: DataFrame) -> DataFrame:
    return emp.groupBy("department").count()


def emp_performance_windows(emp: DataFrame, as_of: dt.date | str | None = None,
                            slots_per_octave: int = 128, pay: DataFrame | None = None) -> DataFrame:
    """Every employee with the department's mean salary, the salary rank (highest
    first, gaps after ties), the percent rank (lowest first) and years of service.
    ``pay`` may give department and salary of the same employees from a cheaper source."""
    pay = emp if pay is None else pay
    known = attach(emp, standings(pay, "department", "salary", slots_per_octave),
                   ["department", "salary"])
    others = F.col("__group_n") - 1
    return known.select(
        *emp.columns,
        F.col("__group_mean").alias("dept_avg_salary"),
        (F.col("__group_n") - F.col("__below") - F.col("__n") + 1).alias("salary_rank"),
        F.when(others > 0, ratio("__below", others)).otherwise(0.0).alias("salary_percentile"),
        years_between(parsed_date("hire_date"), day(as_of)).alias("years_service"),
        (F.col("salary") > F.col("__group_mean")).alias("salary_above_dept_avg"),
    )


def emp_performance_segments(windows: DataFrame, high: tuple[float, float] = (0.8, 3),
                             good: tuple[float, float] = (0.6, 2), average: float = 0.4,
                             labels: Sequence[str] = SEGMENTS) -> DataFrame:
    """``high`` and ``good`` each ask for a percent rank and years of service;
    whoever cannot be judged lands in the last segment."""
    standing, tenure = F.col("salary_percentile"), F.col("years_service")
    segment = (
        F.when((standing >= high[0]) & (tenure >= high[1]), labels[0])
        .when((standing >= good[0]) & (tenure >= good[1]), labels[1])
        .when(standing >= average, labels[2])
        .otherwise(labels[3])
    )
    return windows.withColumn("performance_segment", segment)


def salary_trends(segments: DataFrame, active: str = "Active") -> DataFrame:
    """Per department and segment. Mean, deviation and tenure do not depend on the order
    of rows: tenure is counted in whole days."""
    days = F.rint(F.col("years_service") * F.lit(DAYS_PER_YEAR)).cast("bigint")
    is_active = F.when(F.col("status") == active, 1).otherwise(0)
    return segments.groupBy("department", "performance_segment").agg(
        rows().alias("employee_count"),
        exact_mean("salary").alias("avg_salary"),
        exact_deviation("salary").alias("salary_std"),
        (F.sum(days) / F.lit(DAYS_PER_YEAR) / F.count(days)).alias("avg_tenure"),
        F.sum(is_active).alias("active_employees"),
    )


def salary_trends_top(trends: DataFrame, n: int = 5) -> DataFrame:
    return trends.orderBy(F.desc("avg_salary"), "department", "performance_segment").limit(n)


def top_performers(segments: DataFrame, segment: str = SEGMENTS[0]) -> DataFrame:
    best = segments.where(F.col("performance_segment") == segment)
    return best.select("name", "department", "salary", "years_service", "salary_rank")


def mart_department(emp: DataFrame) -> DataFrame:
    """Salary mass per department and its share of the whole (a window over the few
    groups)."""
    mass = emp.groupBy("department").agg(
        rows().alias("employees"),
        exact_mean("salary").alias("avg_salary"),
        exact_sum("salary").alias("total_salary"),
    )
    everything = F.sum("total_salary").over(Window.partitionBy())
    share = F.round(ratio(F.col("total_salary") * 100.0, everything), 1)
    return mass.withColumn("pct_of_total", share)


def mart_age_group(emp: DataFrame, edges: Sequence[float] = (30, 40),
                   labels: Sequence[str] = AGE_LABELS) -> DataFrame:
    return emp_age_groups(emp, edges, labels).select("age_group", "count", "avg_salary")


def mart_city(emp: DataFrame, min_count: int = 1) -> DataFrame:
    return emp_city_stats(emp, min_count).select(
        "city",
        F.col("employee_count").alias("employees"),
        F.col("avg_salary_city").alias("avg_salary"),
    )


def export_departments(emp: DataFrame) -> DataFrame:
    """Department totals under display headers."""
    mass = mart_department(emp)
    return mass.select(
        F.col("department").alias("Department"),
        F.col("employees").alias("Employees"),
        F.col("avg_salary").alias("Avg Salary"),
        F.col("total_salary").alias("Total Salary"),
    )
