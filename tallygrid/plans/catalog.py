"""Every query by name: how to run it on the driver's tables, and its SQL form.

The thresholds given here fit the value ranges of those tables; the operators'
own defaults fit the small example tables of the tests.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.plans.star import Star


@dataclass(frozen=True)
class Query:
    build: Callable[[Star], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Star(spark, folder))


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated function of a ``Star`` under ``name``."""

    def add(build: Callable[[Star], DataFrame]):
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Query(build, sql)
        return build

    return add


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Round results whose last digit depends on the order of addition."""
    return df.withColumns({n: F.round(n, digits) for n in names})


def load() -> dict[str, Query]:
    from tallygrid.plans import (  # noqa: F401
        customer_queries,
        document_queries,
        employee_queries,
        sales_queries,
        source_queries,
        stream_queries,
    )

    return CATALOG
