import datetime as dt

import pytest

from tallygrid.operators import documents as ops
from tallygrid.sources import schemas, tables


@pytest.fixture(scope="module")
def docs(spark):
    day = dt.datetime(2024, 8, 30)

    def doc(i, category="Toys", region="Asia", amount=10.5, units=2, when=day, **change):
        out = {
            "_id": f"D{i}", "transaction_id": f"T{i}",
            "product": {"id": "P", "name": "Kite", "category": category, "brand": None},
            "sale_info": {"quantity": units, "unit_price": 5.25, "total_amount": amount,
                          "discount": 0.0, "tax": 0.0},
            "customer": {"id": "C", "name": "Ann", "email": None, "loyalty_tier": None},
            "sale_date": when,
            "location": {"region": region, "country": None, "city": None},
            "sales_rep": "Sam", "payment_method": None, "status": "done", "metadata": None,
        }
        return {**out, **change}

    rows = [doc(1), doc(2, amount=20.25), doc(3, region=None), doc(4, location=None),
            doc(5, sale_info=None), doc(6, product=None), doc(7, units=0, category="Air"),
            doc(8, when=day - dt.timedelta(days=40)), doc(9, when=None)]
    return spark.createDataFrame(rows, schemas.SALES_DOCUMENT)


def test_category_rollup_keeps_missing_categories(docs, rows_of):
    assert rows_of(ops.doc_category_rollup(docs)) == [
        ("Air", 1, 10.5), ("Toys", 7, 72.75), (None, 1, 10.5)]


def test_region_rollup_defaults(docs, rows_of):
    got = {r["region"]: (r["total_sales"], r["transactions"])
           for r in ops.doc_region_rollup(docs).collect()}
    assert got == {"Asia": (72.75, 7), "Unknown": (21.0, 2)}


def test_category_sales_price(docs, rows_of):
    got = {r["category"]: tuple(r)[1:] for r in ops.doc_category_sales(docs).collect()}
    assert got["Air"] == (10.5, 1, 0, 0.0)
    assert got["Unknown"] == (10.5, 1, 2, 5.25)
    assert got["Toys"] == (72.75, 7, 12, 72.75 / 12)


def test_recent_sales_window_and_order(docs):
    got = [r["_id"] for r in ops.doc_recent_sales(docs, "2024-08-31", n=3).collect()]
    assert got == ["D1", "D2", "D3"]
    assert ops.doc_recent_sales(docs, "2024-08-31", n=99).count() == 7


def test_export_fills_blanks(docs, rows_of):
    got = {r["Transaction ID"]: tuple(r)[1:] for r in ops.export_sales(docs).collect()}
    assert got["T6"] == ("", "", 10.5, "Asia", "2024-08-30 00:00:00")
    assert got["T5"][2] == 0.0 and got["T4"][3] == "" and got["T9"][4] == ""


def test_find_with_and_without_limit(docs):
    cond = docs["location.region"] == "Asia"
    assert tables.find(docs, cond, n=None).count() == 7
    assert [r["_id"] for r in tables.find(docs, n=2, order=("_id",)).collect()] == ["D1", "D2"]


def test_flat_form_has_the_sales_columns(docs):
    flat = ops.flat_sales(docs)
    assert [(f.name, f.dataType) for f in flat.schema] == [
        (f.name, f.dataType) for f in schemas.SALES]


def test_top_customers(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 3.0)],
                               "customer_id string, total_spent double")
    assert [r[0] for r in ops.doc_top_customers(df, 2).collect()] == ["b", "c"]
