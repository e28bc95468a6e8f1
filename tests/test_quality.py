from tallygrid.operators import quality as ops


def test_report_and_quarantine_agree(make_emp, rows_of):
    df = make_emp({}, {"salary": None}, {"salary": 1.0, "age": 99}, {"hire_date": "soon"},
                  {"id": 0}, {"age": None})
    rules = ops.employee_rules()
    assert rows_of(ops.dq_report(df, rules)) == [
        ("age_out_of_range", 1, 6), ("hire_date_unreadable", 1, 6), ("id_missing", 1, 6),
        ("salary_missing", 1, 6), ("salary_out_of_range", 1, 6)]
    assert rows_of(ops.dq_quarantine(df, rules), "name", "failed") == [
        ("N2", ["salary_missing"]), ("N3", ["salary_out_of_range", "age_out_of_range"]),
        ("N4", ["hire_date_unreadable"]), ("N5", ["id_missing"])]


def test_report_of_an_empty_table(make_emp, rows_of):
    nobody = make_emp({}).where("id < 0")
    assert {r[1:] for r in rows_of(ops.dq_report(nobody, ops.employee_rules()))} == {(0, 0)}


def test_repeated_keys(spark, rows_of):
    df = spark.createDataFrame([("1", "x"), ("1", "y"), ("2", "y"), ("3", None), ("4", None)],
                               "customer_id string, email string")
    assert rows_of(ops.dq_unique_keys(df, ("customer_id", "email"))) == [
        ("customer_id", "1", 2), ("email", "y", 2)]


def test_standard_forms(make_emp, rows_of):
    df = make_emp({"name": "  Ann ", "department": " human resources", "status": "ACTIVE",
                   "city": "new york", "hire_date": " 2020-02-03 "}, {"hire_date": "?"})
    got = rows_of(ops.dq_standardised(df), "name", "department", "status", "city", "hire_date")
    assert [str(v) for v in got[0]] == [
        "Ann", "Human Resources", "Active", "New York", "2020-02-03"]
    assert got[1][4] is None
