"""Distinct counts of spans of days from sketches, and documents without a schema."""

import datetime as dt

from pyspark.sql import functions as F

from tallygrid.operators import documents, sketches
from tallygrid.sources.scratch import fresh_folder


def test_spans_are_within_the_stated_error(spark):
    n = F.col("id")
    visits = spark.range(200_000).select(
        F.date_add(F.lit("2024-01-01"), (n % 60).cast("int")).alias("day"),
        F.concat(F.lit("k"), (n * 31) % 40_009).alias("key"))
    spans = spark.createDataFrame(
        [("one", "2024-01-05", "2024-01-05"), ("all", "2023-01-01", "2025-01-01"), ("some", "2024-01-20", "2024-02-10"),
         ("none", "2022-01-01", "2022-02-01"), ("turned", "2024-02-01", "2024-01-01")], "label string, a string, b string").select(
        "label", F.col("a").cast("date").alias("first_day"), F.col("b").cast("date").alias("last_day"))
    got = dict(map(tuple, sketches.distinct_in_spans(sketches.daily_sketches(visits, "day", "key"), spans).collect()))
    exact = {label: visits.where(F.col("day").between(a, b)).agg(F.count_distinct("key")).first()[0]
             for label, a, b in map(tuple, spans.collect())}
    assert set(got) == {"one", "all", "some"}
    for label, n in got.items():
        assert abs(n - exact[label]) <= 4 * sketches.standard_error() * exact[label]


def test_a_new_day_reads_no_old_one(spark):
    """Days are stored as they come; spans over both read sketches alone."""
    folder = fresh_folder(spark, "sketches")
    for day in (1, 2):
        rows = spark.createDataFrame([(dt.date(2024, 1, day), f"k{i}") for i in range(day * 100)], "day date, key string")
        sketches.daily_sketches(rows, "day", "key").write.mode("append").parquet(folder)
    spans = spark.createDataFrame([("both", dt.date(2024, 1, 1), dt.date(2024, 1, 2))], "label string, first_day date, last_day date")
    got = sketches.distinct_in_spans(spark.read.parquet(folder), spans).first()["distinct"]
    assert abs(got - 200) <= 8


def test_shapes_that_change(spark):
    lines = ['{"product": {"category": "A"}, "sale_info": {"total_amount": 1.5}}', '{"item": {"kind": "A"}, "amount": "2.25"}',
             '{"item": {"kind": 7}, "amount": 3}', '{"amount": "much"}', 'no json', None, '[1]', '{"product": null, "item": {"kind": "B"}}']
    docs = documents.variant_documents(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = {r["category"]: (r["total_transactions"], r["total_sales"]) for r in documents.doc_variant_rollup(docs).collect()}
    assert got == {"A": (2, 3.75), "7": (1, 3.0), "B": (1, None), None: (4, None)}
    objects = docs.where("schema_of_variant(doc) like 'OBJECT%'")
    schema = documents.variant_schema(objects).first()["schema"]
    assert "amount: VARIANT" in schema and "product: OBJECT<category: STRING>" in schema
    assert documents.variant_schema(docs).first()["schema"] == "VARIANT"  # no object has the fields of an array
    assert documents.doc_variant_rollup(docs.where("false")).count() == 0
