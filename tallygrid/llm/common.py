"""What the operators on documents share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.sources.scratch import fresh_folder

# A word is a run of characters outside space, tab, line feed,
# vertical tab, form feed and carriage return. bytes.split() cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def without_blanks(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    kept = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        kept = F.replace(kept, F.lit(blank), F.lit(""))
    return kept


def n_words(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there,
    and whatever reads it again does not compute it again."""
    spark = df.sparkSession
    folder = fresh_folder(spark, label)
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def with_facts(df: DataFrame, facts: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join ``facts``, unique by ``keys``, where null keys match each other."""
    other = facts.withColumnsRenamed({k: f"__fact_{k}" for k in keys})
    match = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"__fact_{k}"))
        match = same if match is None else match & same
    joined = df.join(other, match, how)
    return joined.drop(*(f"__fact_{k}" for k in keys))


#: What tells the rows of an id apart, and those without one.
OWN = "__own"


#: All columns of a row, while others stand beside them.
ROW = "__row"


def with_row(docs: DataFrame, *others: str) -> DataFrame:
    """doc_id, the text's hash, ``others``, and the whole row by itself, so that no name in
    it can clash with a name that is added."""
    return docs.select("doc_id", own_hash(), *others, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(ROW))


def own_hash() -> Column:
    return F.xxhash64("text").alias(OWN)


def without(docs: DataFrame, gone: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id and text hash are not in ``gone``; a row that repeats
    an id and its text stays once. ``ids`` has both of every row that may repeat: texts are
    only shuffled to look for repeated rows if there are any."""
    keys = ["doc_id", OWN]
    left = with_facts(with_row(docs), gone, keys, "left_anti").select(f"{ROW}.*")
    repeated = ids.groupBy(*keys).count().filter("count > 1")
    return left if repeated.isEmpty() else left.dropDuplicates(["doc_id", "text"])


def by_batch(
    make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: ``make`` sets up what one task needs, once, and returns
    the function that turns each batch into batches."""

    def run(batches):
        each = make()
        for batch in batches:
            if batch.num_rows:
                yield from each(batch)

    return run


def in_slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece has about ``most`` bytes in ``column``, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_pylist()
    begin = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield batch.slice(begin)
