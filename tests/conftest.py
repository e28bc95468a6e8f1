import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallygrid.session import session  # noqa: E402
from tallygrid.sources import schemas  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "tests",
        "local[8]",
        {
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before = {}

    def change(**changes):
        for name, value in changes.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture(scope="session")
def make_emp(spark):
    names = [f.name for f in schemas.EMPLOYEES]
    usual = dict(id=1, name="A", age=35, city="Rome", salary=50000.0, department="Ops",
                 hire_date="2020-01-01", status="Active")

    def make(*changes):
        rows = []
        for i, change in enumerate(changes, 1):
            row = {**usual, "id": i, "name": f"N{i}", **change}
            rows.append(tuple(row[n] for n in names))
        return spark.createDataFrame(rows, schemas.EMPLOYEES)

    return make


@pytest.fixture(scope="session")
def make_sales(spark):
    import datetime as dt

    names = [f.name for f in schemas.SALES]
    usual = dict(product_id="P1", product_name="Cup", category="Home", quantity=1, unit_price=10.0,
                 total_amount=10.0, customer_id="C1", customer_name="Ann",
                 sale_date="2024-03-01", region="North", salesperson="Sam")

    def make(*changes):
        rows = []
        for i, change in enumerate(changes, 1):
            row = {"transaction_id": f"T{i}", **usual, **change}
            if isinstance(row["sale_date"], str):
                row["sale_date"] = dt.date.fromisoformat(row["sale_date"])
            rows.append(tuple(row[n] for n in names))
        return spark.createDataFrame(rows, schemas.SALES)

    return make


@pytest.fixture(scope="session")
def rows_of():
    """Rows as plain tuples, sorted."""

    def rows_of(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return rows_of
