"""Data checks. A rule is a name and a condition that is true for a bad row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.functions.dates import parsed_date
from tallygrid.functions.money import rows


def employee_rules(salary: tuple[float, float] = (10000, 200000),
                   age: tuple[int, int] = (18, 70)) -> dict[str, Column]:
    return {
        "id_missing": F.col("id").isNull() | (F.col("id") <= 0),
        "salary_missing": F.col("salary").isNull(),
        "salary_out_of_range": ~F.col("salary").between(*salary),
        "age_out_of_range": ~F.col("age").between(*age),
        "hire_date_unreadable": parsed_date("hire_date").isNull(),
    }


def dq_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Failing rows per rule, from one pass."""
    counts = df.agg(
        *[F.count(F.when(bad, 1)).alias(name) for name, bad in rules.items()],
        rows().alias("__total"),
    )
    lines = counts.unpivot("__total", list(rules), "rule", "n_failed")
    return lines.select("rule", "n_failed", F.col("__total").alias("n_total"))


def dq_quarantine(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that fail any rule, with the names of the rules they fail."""
    names = [F.when(bad, F.lit(name)) for name, bad in rules.items()]
    any_bad = reduce(lambda a, b: a | b, (F.coalesce(bad, F.lit(False)) for bad in rules.values()))
    return df.where(any_bad).withColumn("failed", F.array_compact(F.array(*names)))


def dq_unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Values that occur more than once in a column that should be unique; one scan for all keys."""
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys)))
    values = df.select(each.alias("x")).select("x.key", "x.value").where(F.col("value").isNotNull())
    return values.groupBy("key", "value").agg(rows().alias("n")).where(F.col("n") > 1)


def dq_standardised(df: DataFrame, words: Sequence[str] = ("department", "status", "city"),
                    texts: Sequence[str] = ("name",), dates: Sequence[str] = ("hire_date",)) -> DataFrame:
    """Trimmed text, capitalised words, and real dates (null where unreadable)."""
    changes = {c: F.trim(c) for c in texts}
    changes |= {c: F.initcap(F.trim(c)) for c in words}
    changes |= {c: parsed_date(F.trim(c)) for c in dates}
    return df.withColumns(changes)
