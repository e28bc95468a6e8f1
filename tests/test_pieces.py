"""Sales in pieces: what a large scan or ranking leaves on disk while it runs."""

import datetime as dt
import pathlib
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tallygrid.plans import star as stars
from tallygrid.plans.document_queries import flat
from tallygrid.session import input_bytes
from tallygrid.sources import schemas, scratch

DAY = dt.datetime(2024, 3, 1, 7)


@pytest.fixture
def folder(spark, tmp_path, monkeypatch, settings):
    """4,000 line items: order keys repeated, unknown and null, days null and with several times."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    monkeypatch.setattr(stars, "PIECE", 1)
    monkeypatch.setattr(stars, "MOST_PIECES", 3)
    orders = [(k, k % 7, "O", 1.0, DAY + dt.timedelta(hours=9 * (k % 40)) if k % 9 else None, "1") for k in range(900)]
    orders += [(3, 2, "O", 1.0, DAY, "1"), (3, 2, "O", 1.0, DAY + dt.timedelta(days=2), "1"), (None, 1, "O", 1.0, DAY, "1")]
    lines = [(None if i % 101 == 0 else i % 1000, i % 11, i % 5, i % 4, 1.0 + i % 3, 10.0 + i % 50 / 100, 0.0, 0.0, "N", "O", DAY)
             for i in range(4000)]
    rows = {
        "region": [(0, "North")], "nation": [(0, "Here", 0)],
        "customer": [(k, f"C{k}", 0, 1.0, "M") for k in range(6)],
        "supplier": [(k, f"S{k}", 0, 1.0) for k in range(5)],
        "part": [(k, f"P{k}", "b", f"T{k % 3}", 1, 1.0) for k in range(10)],
        "orders": orders, "lineitem": lines,
    }
    for name, some in rows.items():
        spark.createDataFrame(some, schemas.STAR[name]).write.parquet(f"file://{tmp_path}/{name}.parquet")
    return f"file://{tmp_path}"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return set(files.mkString("\n").split()) if files.size() else set()


def left_behind(spark, before):
    """Shuffle files that are there beside ``before``; they are removed in the background."""
    for _ in range(100):
        if not (left := {f for f in shuffle_files(spark) - before if "shuffle_" in f}):
            break
        time.sleep(0.1)
    return left


@pytest.mark.parametrize("by_day", [False, True])
def test_pieces_hold_every_sale_once(spark, folder, rows_of, by_day):
    whole = stars.Star(spark, folder)
    parts = [rows_of(piece.sales()) for piece in whole.pieces(by_day)]
    assert len(parts) == stars.MOST_PIECES and sum(map(bool, parts)) > 1
    assert sorted((r for part in parts for r in part), key=repr) == rows_of(whole.sales())
    if by_day:
        day = whole.sales().columns.index("sale_date")
        days = [r[day] for part in parts for r in {r[day]: r for r in part}.values()]
        assert len(days) == len(set(days)) and None in days


def test_small_sales_are_one_piece(spark, folder, monkeypatch):
    monkeypatch.setattr(stars, "PIECE", 1 << 40)
    assert stars.Star(spark, folder).n_pieces() == len([*stars.Star(spark, folder).pieces()]) == 1


def test_scanned_documents_take_little_disk(spark, folder, rows_of):
    known, before = set(scratch._made), shuffle_files(spark)
    got = queries()["doc_sales_scan"](spark, folder)
    assert not left_behind(spark, before)
    held = input_bytes(spark, *(set(scratch._made) - known))
    expected = rows_of(flat(stars.Star(spark, folder).documents()))
    assert rows_of(got) == expected
    assert held < 100 * len(expected)


def test_daily_rank_of_many_pieces_leaves_only_its_rows(spark, folder, rows_of):
    known, before = set(scratch._made), shuffle_files(spark)
    got = queries()["sales_daily_rank"](spark, folder)
    assert not left_behind(spark, before)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Window" not in text
    sizes = {f: sum(p.stat().st_size for p in pathlib.Path(f.removeprefix("file:")).rglob("*.parquet"))
             for f in set(scratch._made) - known}
    assert sorted(map(bool, sizes.values())) == [False, False, True]
    sales = stars.Star(spark, folder).sales()
    by_day = Window.partitionBy("sale_date").orderBy(F.desc("total_amount"))
    plain = sales.withColumn("daily_rank", F.rank().over(by_day).cast("long"))
    assert got.columns == plain.columns and rows_of(got) == rows_of(plain)
