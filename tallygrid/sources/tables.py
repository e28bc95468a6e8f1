"""Readers for flat tables and document collections."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrid.functions.money import rows
from tallygrid.sources import schemas


#: How cells of comma text are told apart, for readers and writers.
TEXT_CELLS = {"quote": '"', "escape": '"', "nullValue": "", "lineSep": "\n"}
_EMPTY = "\x02empty\x02"  # stands for "" between Spark's reader, which takes it for null, and ours


def _read_text(spark: SparkSession, path: str, schema: T.StructType | None, header: bool,
               line_breaks: bool) -> DataFrame:
    """Comma text as our writers make it: an empty cell is null, two quotes are empty text.

    ``line_breaks``: cells may go over lines. Spark reads such a file in one task, so it is
    to be asked for, and files should be of a size that one task can read.
    """
    reader = spark.read.options(**TEXT_CELLS, header=header, inferSchema=False, dateFormat="yyyy-MM-dd",
                                emptyValue=_EMPTY, multiLine=line_breaks)
    df = (reader if schema is None else reader.schema(schema)).csv(path)
    own = {f.name: F.when(F.col(f"`{f.name}`") == _EMPTY, "").otherwise(F.col(f"`{f.name}`"))
           for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.withColumns(own)


def read_positional(spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = False) -> DataFrame:
    """Comma text whose columns are known by position only; bad cells become null."""
    return _read_text(spark, path, schema, False, line_breaks)


def read_with_header(spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = False) -> DataFrame:
    """Comma text with a header line and a declared schema, dates as yyyy-MM-dd."""
    return _read_text(spark, path, schema, True, line_breaks)


def read_all_strings(spark: SparkSession, path: str, line_breaks: bool = False) -> DataFrame:
    """Comma text with a header line, every column left as text."""
    return _read_text(spark, path, None, True, line_breaks)


def read_employees(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    read = read_with_header if header else read_positional
    return read(spark, path, schemas.EMPLOYEES)


def read_sales(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Sales with a typed date; without a header the date stays text."""
    if header:
        return read_with_header(spark, path, schemas.SALES)
    return read_positional(spark, path, schemas.SALES_TEXT)


def read_collection(
    spark: SparkSession,
    path: str | None = None,
    schema: T.StructType | None = None,
    source: str = "json",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A document collection from JSON or parquet files, or from any connector
    on the classpath named by ``source`` and configured by ``options``.

    Without a schema Spark infers one, which reads the files once more.
    """
    reader = spark.read.format(source).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def find(
    docs: DataFrame,
    where: Column | None = None,
    n: int | None = None,
    id_column: str = "_id",
    order: tuple[Column | str, ...] = (),
) -> DataFrame:
    """Matching documents with a text id; all of them, or the first ``n``."""
    out = docs if where is None else docs.where(where)
    if order:
        out = out.orderBy(*order)
    if n is not None:
        out = out.limit(n)
    return out.withColumn(id_column, F.col(id_column).cast("string"))


def preview(df: DataFrame, n: int = 5, order: tuple[Column | str, ...] = ()) -> DataFrame:
    """The first rows, in the given order when there is one."""
    return (df.orderBy(*order) if order else df).limit(n)


def collection_profile(collections: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every collection."""
    parts = [
        df.agg(rows().alias("count")).select(F.lit(name).alias("collection"), "count")
        for name, df in collections.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def collection_samples(collections: Mapping[str, DataFrame], n: int = 3,
                       order: str = "_id") -> DataFrame:
    """The first ``n`` documents of every collection as JSON text, by ``order`` and then by
    that text, so that documents with one id have an order too."""
    parts = [
        df.orderBy(order, F.to_json(F.struct(*df.columns))).limit(n).select(
            F.lit(name).alias("collection"), F.to_json(F.struct(*df.columns)).alias("document")
        )
        for name, df in collections.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def map_double(df: DataFrame, c: str, name: str = "doubled") -> DataFrame:
    """One column times two."""
    return df.select(c, (F.col(c) * 2).alias(name))


def register(views: Mapping[str, DataFrame]) -> None:
    """Make the tables usable from ``spark.sql``."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
