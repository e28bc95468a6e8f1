"""Logical tables projected from a star schema in parquet.

A sale is one line item. Everything else about it is looked up by a unique key
with left joins, so the number of sales never depends on which columns are
wanted, and a lookup whose columns are not wanted is not joined at all. Orders
are completed before they meet the line items: the largest table is shuffled
for its order key once, and per further lookup only when that lookup is too
large to broadcast by Spark's own size check.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.session import input_bytes
from tallygrid.sources import schemas, sinks
from tallygrid.sources.scratch import fresh_folder, remove, tidy_session

SALES_COLUMNS = tuple(f.name for f in schemas.SALES)
EMPLOYEE_COLUMNS = tuple(f.name for f in schemas.EMPLOYEES)
PART_COLUMNS = {"product_name", "category"}
CUSTOMER_COLUMNS = {"customer_name", "region"}
ORDER_COLUMNS = {"customer_id", "sale_date"} | CUSTOMER_COLUMNS
#: Bytes of line items, as they are stored, in one piece of the sales. Every piece reads the
#: other tables, so the number of pieces does not grow without end.
PIECE = 64 << 20
MOST_PIECES = 10
PIECE_COLUMN = "__piece"
#: What sales need of a line item and of an order.
LINE_NEEDS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
ORDER_NEEDS = ("o_orderkey", "o_custkey", "o_orderdate")


def dealt(key: Column, n: int) -> Column:
    """The piece of ``n`` that a key falls into, 0 for null."""
    return F.when(key.isNull(), 0).otherwise(F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))


class Star:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            reader = self.spark.read.schema(schemas.STAR[name])
            self._tables[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def n_pieces(self) -> int:
        held = input_bytes(self.spark, f"{self.folder}/lineitem.parquet")
        return max(1, min(-(-held // PIECE), MOST_PIECES))

    def pieces(self, by_day: bool = False) -> Iterator[Star]:
        """Stars that together have every sale once, ``by_day`` with all sales of a day in one
        of them. Their session removes shuffle files after every write: if what is made of one
        piece is written before the next is taken, the disk holds those of a single piece.

        What sales need of line items and orders is dealt out to scratch folders, by order or
        by the days of an order; a piece's files go when the next is taken.
        """
        n = self.n_pieces()
        whole = Star(tidy_session(self.spark), self.folder)
        if n == 1:
            yield whole
            return
        orders = whole.table("orders").select(*ORDER_NEEDS)
        lines = whole.table("lineitem").select(*LINE_NEEDS)
        if by_day:
            orders = orders.withColumn(PIECE_COLUMN, dealt(F.col("o_orderdate").cast("date"), n))
            # An order's key may be repeated, with several days.
            held = orders.select("o_orderkey", PIECE_COLUMN).distinct()
            lines = lines.join(held, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
                *LINE_NEEDS, F.coalesce(PIECE_COLUMN, F.lit(0)).alias(PIECE_COLUMN))
        else:
            orders = orders.withColumn(PIECE_COLUMN, dealt(F.col("o_orderkey"), n))
            lines = lines.withColumn(PIECE_COLUMN, dealt(F.col("l_orderkey"), n))
        tables = {"orders": orders, "lineitem": lines}
        folders = {name: fresh_folder(self.spark, name) for name in tables}
        for name, table in tables.items():
            sinks.add_rows(table, folders[name], [PIECE_COLUMN])
        for i in range(n):
            piece = Star(whole.spark, self.folder)
            for name, table in tables.items():
                stored = whole.spark.read.schema(table.schema).parquet(folders[name])
                piece._tables[name] = stored.where(F.col(PIECE_COLUMN) == i).drop(PIECE_COLUMN)
            yield piece
            for folder in folders.values():
                remove(self.spark, f"{folder}/{PIECE_COLUMN}={i}")

    def _nations(self, regions: bool = False) -> DataFrame:
        """Nations, on request with their region."""
        nation = self.table("nation")
        if regions:
            region = self.table("region")
            nation = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        return nation

    def _orders(self, wanted: set[str]) -> DataFrame:
        orders = self.table("orders").select(*ORDER_NEEDS)
        if wanted & CUSTOMER_COLUMNS:
            customer = self.table("customer").select("c_custkey", "c_name", "c_nationkey")
            if "region" in wanted:
                nations = self._nations(regions=True)
                customer = customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        return orders

    def sales(self, *columns: str) -> DataFrame:
        """The sales table, or the given columns of it."""
        wanted = set(columns or SALES_COLUMNS)
        lines = self.table("lineitem")
        if wanted & ORDER_COLUMNS:
            orders = self._orders(wanted)
            lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        if wanted & PART_COLUMNS:
            part = self.table("part").select("p_partkey", "p_name", "p_type")
            lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        if "salesperson" in wanted:
            supplier = self.table("supplier").select("s_suppkey", "s_name")
            lines = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")

        units = F.col("l_quantity").cast("int")
        values = {
            "transaction_id": lambda: F.concat_ws(
                "-",
                F.concat(F.lit("T"), F.col("l_orderkey").cast("string")),
                F.col("l_linenumber").cast("string"),
                F.col("l_partkey").cast("string"),
            ),
            "order_key": lambda: F.col("l_orderkey"),
            "line_key": lambda: F.col("l_linenumber"),
            "part_key": lambda: F.col("l_partkey"),
            "product_id": lambda: F.col("l_partkey").cast("string"),
            "product_name": lambda: F.col("p_name"),
            "category": lambda: F.col("p_type"),
            "quantity": lambda: units,
            # The price of one unit in whole cents, half a cent rounded up.
            "unit_price": lambda: F.expr(
                "(2 * cast(rint(l_extendedprice * 100) as bigint) + cast(l_quantity as bigint))"
                " div (2 * nullif(cast(l_quantity as bigint), 0)) / 100D"
            ),
            "total_amount": lambda: F.col("l_extendedprice"),
            "customer_id": lambda: F.col("o_custkey").cast("string"),
            "customer_name": lambda: F.col("c_name"),
            "sale_date": lambda: F.col("o_orderdate").cast("date"),
            "region": lambda: F.col("r_name"),
            "salesperson": lambda: F.col("s_name"),
        }
        return lines.select(*[values[c]().alias(c) for c in columns or SALES_COLUMNS])

    def employees(self, *columns: str) -> DataFrame:
        """The employee table, or the given columns of it."""
        people = self.table("customer")
        if not columns or "city" in columns:
            people = people.join(
                self._nations(), F.col("c_nationkey") == F.col("n_nationkey"), "left"
            )
        key = F.col("c_custkey")
        hired = F.date_add(F.lit("2016-01-01").cast("date"), ((key * 37) % 2400).cast("int"))
        values = {
            "id": key,
            "name": F.col("c_name"),
            "age": (18 + key % 55).cast("int"),
            "city": F.col("n_name"),
            "salary": F.col("c_acctbal"),
            "department": F.col("c_mktsegment"),
            "hire_date": hired.cast("string"),
            "status": F.when(key % 25 == 0, "Inactive").otherwise("Active"),
        }
        return people.select(*[values[c].alias(c) for c in columns or EMPLOYEE_COLUMNS])

    def raw_employees(self) -> DataFrame:
        """Employees as they might arrive: blanks, other letter case, missing
        salaries and unreadable dates."""
        key = F.col("id")
        return self.employees().withColumns(
            {
                "name": F.concat(F.lit("  "), "name", F.lit(" ")),
                "department": F.when(key % 3 == 0, F.lower("department")).otherwise(F.col("department")),
                "status": F.when(key % 7 == 0, F.upper("status")).otherwise(F.col("status")),
                "salary": F.when(key % 53 != 0, F.col("salary")),
                "hire_date": F.when(key % 41 == 0, "unknown").otherwise(F.col("hire_date")),
            }
        )

    def documents(self, *columns: str) -> DataFrame:
        """Sales as nested documents, some without a location, product or sale info.

        ``columns`` are the flat sales columns the documents need; the fields of
        the others are null.
        """
        needed = list(dict.fromkeys((*(columns or SALES_COLUMNS), "transaction_id")))
        absent = {f.name: F.lit(None).cast(f.dataType) for f in schemas.SALES if f.name not in needed}
        keys = ("order_key", "line_key", "part_key")
        flat = self.sales(*needed, *keys).withColumns(absent) if absent else self.sales(*needed, *keys)
        order, line, part = (F.col(k) for k in keys)
        money = F.col("total_amount")
        stamp = F.col("sale_date").cast("timestamp")
        nothing = F.lit(None).cast("string")
        product = F.struct(
            F.col("product_id").alias("id"),
            F.col("product_name").alias("name"),
            F.col("category"),
            nothing.alias("brand"),
        )
        info = F.struct(
            F.col("quantity"),
            F.col("unit_price"),
            money.alias("total_amount"),
            F.lit(0.0).alias("discount"),
            F.lit(0.0).alias("tax"),
        )
        customer = F.struct(
            F.col("customer_id").alias("id"),
            F.col("customer_name").alias("name"),
            nothing.alias("email"),
            nothing.alias("loyalty_tier"),
        )
        location = F.struct(
            F.when(order % 13 != 0, F.col("region")).alias("region"),
            nothing.alias("country"),
            nothing.alias("city"),
        )
        metadata = F.struct(
            F.when(line % 2 == 0, "online").otherwise("store").alias("source"),
            nothing.alias("campaign"),
            stamp.alias("created_at"),
        )
        return flat.select(
            F.concat(F.lit("D"), "transaction_id").alias("_id"),
            "transaction_id",
            F.when(part % 17 != 0, product).alias("product"),
            F.when(order % 19 != 0, info).alias("sale_info"),
            customer.alias("customer"),
            stamp.alias("sale_date"),
            F.when(order % 11 != 0, location).alias("location"),
            F.col("salesperson").alias("sales_rep"),
            nothing.alias("payment_method"),
            F.lit("completed").alias("status"),
            metadata.alias("metadata"),
        )

    def customer_documents(self) -> DataFrame:
        """Customers and suppliers. Customers in debt have another id here, and suppliers
        buy nothing: some sales have no document, some documents no sale. Some share an
        address."""
        customer, supplier = self.table("customer"), self.table("supplier")
        key = F.col("c_custkey")
        shared = F.when(key % 97 == 1, key - key % 194).otherwise(key)
        own = key.cast("string")
        people = customer.select(
            F.when(F.col("c_acctbal") < 0, F.concat(F.lit("X"), own)).otherwise(own).alias("customer_id"),
            F.col("c_name").alias("name"),
            F.concat(F.lit("c"), shared.cast("string"), F.lit("@example.com")).alias("email"),
            F.element_at(
                F.array(*[F.lit(t) for t in ("Bronze", "Silver", "Gold", "Platinum")]),
                (key % 4 + 1).cast("int"),
            ).alias("loyalty_tier"),
            (key % 50).cast("int").alias("total_orders"),
            F.col("c_acctbal").alias("total_spent"),
            F.array(F.col("c_mktsegment")).alias("preferences"),
        )
        firm = F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))
        prospects = supplier.select(
            firm.alias("customer_id"),
            F.col("s_name").alias("name"),
            F.concat(firm, F.lit("@example.com")).alias("email"),
            F.lit("Bronze").alias("loyalty_tier"),
            F.lit(0).alias("total_orders"),
            F.lit(0.0).alias("total_spent"),
            F.array(F.lit("WHOLESALE")).alias("preferences"),
        )
        known = people.unionByName(prospects).withColumn("_id", F.concat(F.lit("K"), "customer_id"))
        return known.select(
            *[
                (F.col(f.name) if f.name in known.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in schemas.CUSTOMER_DOCUMENT
            ]
        )
