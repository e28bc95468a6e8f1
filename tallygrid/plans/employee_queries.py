"""Workforce queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrid.operators import employees as emp
from tallygrid.operators import quality
from tallygrid.plans.catalog import query
from tallygrid.plans.oracle import deviation, int_mean, mean, over, total
from tallygrid.plans.star import Star

AS_OF = "2024-08-31"
SALARY_EDGES = (2000, 6000)
SALARY_RANGE = (0, 9500)
CITY_MINIMUM = 55


def staff(star: Star, *columns: str):
    """Clean employees, or the id and the given columns of them."""
    return emp.emp_clean(star.employees(*dict.fromkeys(("id", *columns)) if columns else ()))


AGE_BAND = """CASE WHEN age < 30 THEN 'Young (< 30)' WHEN age < 40 THEN 'Middle (30-39)'
  WHEN age >= 40 THEN 'Senior (40+)' END"""
SALARY_BAND = """CASE WHEN salary < 2000 THEN 'Low (< 2K)' WHEN salary < 6000 THEN 'Medium (2K-6K)'
  WHEN salary >= 6000 THEN 'High (6K+)' END"""
ODD_ROW = "salary < 0 OR salary > 9500 OR age < 18 OR age > 70"


@query("emp_clean", over("SELECT * FROM emp"))
def _(star):
    return staff(star)


@query("emp_total", over("SELECT count(*) AS total_count FROM emp"))
def _(star):
    return emp.emp_total(staff(star, "id"))


@query("emp_department_stats", over(f"""
SELECT department, count(*) AS employee_count, {mean('salary')} AS avg_salary,
       min(salary) AS min_salary, max(salary) AS max_salary, {int_mean('age')} AS avg_age
FROM emp GROUP BY department ORDER BY employee_count DESC, department"""))
def _(star):
    return emp.emp_department_stats(staff(star, "department", "salary", "age"))


@query("emp_city_stats", over(f"""
SELECT city, count(*) AS employee_count, {mean('salary')} AS avg_salary_city
FROM emp GROUP BY city HAVING count(*) > {CITY_MINIMUM}"""))
def _(star):
    return emp.emp_city_stats(staff(star), min_count=CITY_MINIMUM)


@query("emp_age_groups", over(f"""
SELECT {AGE_BAND} AS age_group, count(*) AS count, {mean('salary')} AS avg_salary,
       {int_mean('age')} AS avg_age
FROM emp GROUP BY 1"""))
def _(star):
    return emp.emp_age_groups(staff(star, "salary", "age"))


@query("emp_salary_brackets", over(f"""
SELECT {SALARY_BAND} AS salary_bracket, count(*) AS count, {mean('salary')} AS avg_salary,
       {int_mean('age')} AS avg_age
FROM emp GROUP BY 1"""))
def _(star):
    return emp.emp_salary_brackets(staff(star, "salary", "age"), edges=SALARY_EDGES,
                                   labels=("Low (< 2K)", "Medium (2K-6K)", "High (6K+)"))


@query("emp_status", over(f"""
SELECT status, count(*) AS count, {mean('salary')} AS avg_salary,
       count(*) * 100.0::double / sum(count(*)) OVER () AS percentage
FROM emp GROUP BY status"""))
def _(star):
    return emp.emp_status(staff(star, "status", "salary"))


@query("emp_top_earners", over("""
SELECT name, department, city, salary, age FROM emp ORDER BY salary DESC, name, id LIMIT 10"""))
def _(star):
    return emp.emp_top_earners(staff(star))


@query("emp_department_report", over(f"""
SELECT 'Department: ' || department || ' | Employees: ' || count(*)
       || ' | Avg Salary: $' || round({mean('salary')})::bigint
       || ' | Avg Age: ' || round({int_mean('age')})::bigint AS report_line
FROM emp GROUP BY department"""))
def _(star):
    return emp.emp_department_report(staff(star, "department", "salary", "age"))


@query("emp_anomalies", over(f"SELECT * FROM emp WHERE {ODD_ROW}"))
def _(star):
    return emp.emp_anomalies(staff(star), salary=SALARY_RANGE)


USUAL_BAND = """CASE WHEN salary < 60000 THEN 'Low (< 60K)' WHEN salary < 80000 THEN 'Medium (60K-80K)'
  WHEN salary >= 80000 THEN 'High (80K+)' END"""
USUALLY_ODD = "salary < 10000 OR salary > 200000 OR age < 18 OR age > 70"


def raised(star, *columns):
    """Employees with salaries in the range that the operators' own cuts are made for."""
    return staff(star, *columns).withColumn("salary", F.col("salary") * 10)


RAISED = "raised AS (SELECT * REPLACE (salary * 10 AS salary) FROM emp)"


@query("emp_salary_brackets_usual", over(f"""
WITH {RAISED}
SELECT {USUAL_BAND} AS salary_bracket, count(*) AS count, {mean('salary')} AS avg_salary,
       {int_mean('age')} AS avg_age FROM raised GROUP BY 1"""))
def _(star):
    return emp.emp_salary_brackets(raised(star, "salary", "age"))


@query("emp_anomalies_usual", over(f"WITH {RAISED} SELECT * FROM raised WHERE {USUALLY_ODD}"))
def _(star):
    return emp.emp_anomalies(raised(star))


@query("emp_city_stats_usual", over(f"""
SELECT city, count(*) AS employee_count, {mean('salary')} AS avg_salary_city
FROM emp GROUP BY city HAVING count(*) > 1"""))
def _(star):
    return emp.emp_city_stats(staff(star))


@query("emp_anomaly_count", over(f"SELECT count(*) AS anomaly_count FROM emp WHERE {ODD_ROW}"))
def _(star):
    return emp.emp_anomaly_count(staff(star, "salary", "age"), salary=SALARY_RANGE)


@query("emp_department_count", over(
    "SELECT department, count(*) AS count FROM emp GROUP BY department"))
def _(star):
    return emp.emp_department_count(staff(star, "department"))


WINDOWS = f"""
SELECT emp.*,
       sum(salary::decimal(18,2)) OVER d ::double / count(salary) OVER d AS dept_avg_salary,
       rank() OVER (PARTITION BY department ORDER BY salary DESC) AS salary_rank,
       percent_rank() OVER (PARTITION BY department ORDER BY salary) AS salary_percentile,
       date_diff('day', hire_date::date, date '{AS_OF}') / 365.25::double AS years_service,
       salary > sum(salary::decimal(18,2)) OVER d ::double / count(salary) OVER d
         AS salary_above_dept_avg
FROM emp WINDOW d AS (PARTITION BY department)"""
SEGMENTED = f"""
WITH windows AS ({WINDOWS}), segments AS (
SELECT *, CASE WHEN salary_percentile >= 0.8::double AND years_service >= 3 THEN 'High Performer'
               WHEN salary_percentile >= 0.6::double AND years_service >= 2 THEN 'Good Performer'
               WHEN salary_percentile >= 0.4::double THEN 'Average Performer'
               ELSE 'Developing' END AS performance_segment
FROM windows), trends AS (
SELECT department, performance_segment, count(*) AS employee_count, {mean('salary')} AS avg_salary,
       {deviation('salary')} AS salary_std,
       sum(date_diff('day', hire_date::date, date '{AS_OF}'))::double / 365.25::double / count(hire_date) AS avg_tenure,
       sum(CASE WHEN status = 'Active' THEN 1 ELSE 0 END)::bigint AS active_employees
FROM segments GROUP BY department, performance_segment)"""


JUDGED_BY = ("department", "salary", "hire_date")


def windows(star, *columns):
    return emp.emp_performance_windows(staff(star, *columns), as_of=AS_OF, pay=staff(star, "department", "salary"))


def segments(star, *columns):
    return emp.emp_performance_segments(windows(star, *columns))


def trends(star):
    return emp.salary_trends(segments(star, *JUDGED_BY, "status"))


@query("emp_performance_windows", over(WINDOWS))
def _(star):
    return windows(star)


@query("emp_performance_segments", over(SEGMENTED + "SELECT * FROM segments"))
def _(star):
    return segments(star)


@query("emp_salary_trends", over(SEGMENTED + "SELECT * FROM trends"))
def _(star):
    return trends(star)


@query("emp_top_performers", over(SEGMENTED + """
SELECT name, department, salary, years_service, salary_rank FROM segments
WHERE performance_segment = 'High Performer'"""))
def _(star):
    return emp.top_performers(segments(star, *JUDGED_BY, "name"))


@query("emp_salary_trends_top5", over(SEGMENTED + """
SELECT * FROM trends ORDER BY avg_salary DESC, department, performance_segment LIMIT 5"""))
def _(star):
    return emp.salary_trends_top(trends(star))


MASS = f"""
SELECT department, count(*) AS employees, {mean('salary')} AS avg_salary,
       {total('salary')} AS total_salary FROM emp GROUP BY department"""


@query("mart_department", over(f"""
SELECT *, round(total_salary * 100.0::double / sum(total_salary) OVER (), 1) AS pct_of_total
FROM ({MASS})"""))
def _(star):
    return emp.mart_department(staff(star, "department", "salary"))


@query("mart_age_group", over(f"""
SELECT {AGE_BAND} AS age_group, count(*) AS count, {mean('salary')} AS avg_salary
FROM emp GROUP BY 1"""))
def _(star):
    return emp.mart_age_group(staff(star, "salary", "age"))


@query("mart_city", over(f"""
SELECT city, count(*) AS employees, {mean('salary')} AS avg_salary
FROM emp GROUP BY city HAVING count(*) > {CITY_MINIMUM}"""))
def _(star):
    return emp.mart_city(staff(star), min_count=CITY_MINIMUM)


@query("export_departments", over(f"""
SELECT department AS "Department", employees AS "Employees", avg_salary AS "Avg Salary",
       total_salary AS "Total Salary" FROM ({MASS})"""))
def _(star):
    return emp.export_departments(staff(star, "department", "salary"))


RULES = {
    "id_missing": "id IS NULL OR id <= 0",
    "salary_missing": "salary IS NULL",
    "salary_out_of_range": "NOT salary BETWEEN 0 AND 9500",
    "age_out_of_range": "NOT age BETWEEN 18 AND 70",
    "hire_date_unreadable": "try_cast(hire_date AS date) IS NULL",
}


@query("dq_report", over(" UNION ALL ".join(
    f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {bad}) AS n_failed, count(*) AS n_total "
    "FROM raw_emp" for name, bad in RULES.items())))
def _(star):
    return quality.dq_report(star.raw_employees(), quality.employee_rules(salary=SALARY_RANGE))


@query("dq_quarantine", over(f"""
SELECT *, concat_ws('|', {', '.join(f"CASE WHEN {bad} THEN '{name}' END"
                                     for name, bad in RULES.items())}) AS failed
FROM raw_emp WHERE {' OR '.join(f'({bad})' for bad in RULES.values())}"""))
def _(star):
    rules = quality.employee_rules(salary=SALARY_RANGE)
    bad = quality.dq_quarantine(star.raw_employees(), rules)
    return bad.withColumn("failed", F.array_join("failed", "|"))


@query("dq_standardised", over("""
SELECT id, trim(name) AS name, age, upper(city[1]) || lower(city[2:]) AS city, salary,
       upper(department[1]) || lower(department[2:]) AS department,
       try_cast(hire_date AS date) AS hire_date,
       upper(status[1]) || lower(status[2:]) AS status
FROM raw_emp"""))
def _(star):
    return quality.dq_standardised(star.raw_employees())
