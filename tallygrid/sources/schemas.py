"""Declared schemas of the logical tables."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
DATE, INSTANT, ZONELESS = T.DateType(), T.TimestampType(), T.TimestampNTZType()


def _row(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


#: The id is a long so that it can count past two billion.
EMPLOYEES = _row(
    id=LONG, name=TEXT, age=INT, city=TEXT, salary=DOUBLE, department=TEXT, hire_date=TEXT, status=TEXT
)

SALES = _row(
    transaction_id=TEXT,
    product_id=TEXT,
    product_name=TEXT,
    category=TEXT,
    quantity=INT,
    unit_price=DOUBLE,
    total_amount=DOUBLE,
    customer_id=TEXT,
    customer_name=TEXT,
    sale_date=DATE,
    region=TEXT,
    salesperson=TEXT,
)

#: Sales with the date kept as text, as the headerless loader has it.
SALES_TEXT = _row(**{f.name: TEXT if f.name == "sale_date" else f.dataType for f in SALES})

SALES_DOCUMENT = _row(
    _id=TEXT,
    transaction_id=TEXT,
    product=_row(id=TEXT, name=TEXT, category=TEXT, brand=TEXT),
    sale_info=_row(quantity=INT, unit_price=DOUBLE, total_amount=DOUBLE, discount=DOUBLE, tax=DOUBLE),
    customer=_row(id=TEXT, name=TEXT, email=TEXT, loyalty_tier=TEXT),
    sale_date=INSTANT,
    location=_row(region=TEXT, country=TEXT, city=TEXT),
    sales_rep=TEXT,
    payment_method=TEXT,
    status=TEXT,
    metadata=_row(source=TEXT, campaign=TEXT, created_at=INSTANT),
)

CUSTOMER_DOCUMENT = _row(
    _id=TEXT,
    customer_id=TEXT,
    name=TEXT,
    email=TEXT,
    phone=TEXT,
    address=_row(street=TEXT, city=TEXT, country=TEXT, postal_code=TEXT),
    loyalty_tier=TEXT,
    registration_date=INSTANT,
    total_orders=INT,
    total_spent=DOUBLE,
    last_order_date=INSTANT,
    preferences=T.ArrayType(TEXT),
    marketing_consent=T.BooleanType(),
)

#: The star schema the logical tables are projected from. Declaring it saves a
#: footer-reading job per table.
STAR = {
    "region": _row(r_regionkey=INT, r_name=TEXT),
    "nation": _row(n_nationkey=INT, n_name=TEXT, n_regionkey=INT),
    "customer": _row(
        c_custkey=LONG, c_name=TEXT, c_nationkey=INT, c_acctbal=DOUBLE, c_mktsegment=TEXT
    ),
    "supplier": _row(s_suppkey=LONG, s_name=TEXT, s_nationkey=INT, s_acctbal=DOUBLE),
    "part": _row(
        p_partkey=LONG, p_name=TEXT, p_brand=TEXT, p_type=TEXT, p_size=INT, p_retailprice=DOUBLE
    ),
    "orders": _row(
        o_orderkey=LONG,
        o_custkey=LONG,
        o_orderstatus=TEXT,
        o_totalprice=DOUBLE,
        o_orderdate=ZONELESS,
        o_orderpriority=TEXT,
    ),
    "lineitem": _row(
        l_orderkey=LONG,
        l_partkey=LONG,
        l_suppkey=LONG,
        l_linenumber=INT,
        l_quantity=DOUBLE,
        l_extendedprice=DOUBLE,
        l_discount=DOUBLE,
        l_tax=DOUBLE,
        l_returnflag=TEXT,
        l_linestatus=TEXT,
        l_shipdate=ZONELESS,
    ),
}

EVENTS = _row(
    event_id=LONG, ts=ZONELESS, user_id=LONG, event_type=TEXT, value=DOUBLE, props=TEXT
)
