"""Token counts of documents in flat token files.

A token file holds the ids of its documents, two bytes each, and after each document an
end mark; it has no index. Method: separator scan. Files are searched in blocks for the
end mark, all ids of a block at once; a running sum over a file's blocks then gives each
mark its place and number, and a document that spans blocks its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygrid.llm.common import by_batch, in_slices
from tallygrid.llm.tokens import IDS, VOCABULARY, public_path, tokens
from tallygrid.sources.scratch import fresh_folder

# The vocabulary's own end mark, 49407. No text may give it, so special tokens that are
# spelled out in a text are tokenized as ordinary text.
END = 49407
BLOCK = 1 << 19  # ids


def _encoded(path: str):
    def make():
        known = tokens(path, spelled_out=True)

        def each(batch):
            for part in in_slices(batch, "text", 1 << 23):
                ids = [known.of(t) for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["ids"])

        return each

    return by_batch(make)


def write_token_files(docs: DataFrame, folder: str, vocabulary: str | None = None) -> None:
    """One flat file for each task of the scan. Spark's line writer puts the end mark, as
    its line separator, after the ids of each row; null text has no ids.

    The writer commits whole files, so a lost executor leaves none half written.
    """
    path = vocabulary or public_path(VOCABULARY)
    mark = np.array([END], dtype=IDS).tobytes().decode("latin-1")
    encoded = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(_encoded(path), "ids binary")
    (encoded.select(F.col("ids").cast("string").alias("value")).write
     .option("encoding", "ISO-8859-1").option("lineSep", mark).text(folder))


def _marks(batches):
    """(file, block, ids, ends): the places of the end marks within each block."""
    for batch in batches:
        for path, block, content in zip(*(batch[c].to_pylist() for c in ("file", "block", "content")),
                                        strict=True):
            ids = np.frombuffer(content, IDS)
            ends = np.flatnonzero(ids == END)
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([block], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([ends.astype(np.int64)], pa.list_(pa.int64()))],
                names=["file", "block", "ids", "ends"])


def counts(spark: SparkSession, folder: str, block: int = BLOCK) -> DataFrame:
    """One row a document: file, document (its number in the file), start (ids and marks
    before it) and n_tokens, without the mark.

    Ids after a file's last mark are an unfinished document and counted as one. A file of
    odd length is an error, and so is one over 2 GB, Spark's limit for a binary file.
    Without files the result is empty.
    """
    width = IDS.itemsize
    size = block * width
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    whole = F.when(F.col("length") % width == 0, F.col("length")).otherwise(
        F.raise_error(F.concat(F.lit("odd length: "), F.col("path"))).cast("long"))
    name = F.element_at(F.split("path", "/"), -1)
    blocks = files.filter("length > 0").select(
        name.alias("file"), "content",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((whole - 1) / size))).alias("block")
    ).select("file", "block", F.substring("content", (F.col("block") * size + 1).cast("int"), F.lit(size)).alias(
        "content"))
    found = blocks.mapInArrow(_marks, "file string, block long, ids long, ends array<long>")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("file").orderBy(F.desc("block"))
    placed = (
        found.withColumn("n", F.size("ends"))
        .withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))
        .withColumn("number", F.coalesce(F.sum("n").over(before), F.lit(0)))
        # Where the document that reaches into this block began: after the last mark so far.
        .withColumn("last", F.when(F.col("n") > 0, F.col("base") + F.element_at("ends", -1) + 1))
        .withColumn("open", F.coalesce(F.max("last").over(before), F.lit(0)))
        .withColumn("final", F.row_number().over(after) == 1)
    )
    closing = F.transform("ends", lambda e: e + F.col("base"))
    rest = F.col("base") + F.col("ids")
    unfinished = F.col("final") & (F.coalesce("last", "open") < rest)
    ends = F.when(unfinished, F.concat(closing, F.array(rest))).otherwise(closing)
    starts = F.concat(F.array("open"), F.transform(closing, lambda e: e + 1))
    # Joined place by place: looking starts up in a lambda would make them again for each document.
    spans = F.zip_with(F.slice(starts, F.lit(1), F.size(ends)), ends, lambda s, e: F.struct(
        s.alias("start"), (e - s).alias("n_tokens")))
    return placed.select("file", "number", F.posexplode(spans).alias("i", "d")).select(
        "file", (F.col("number") + F.col("i")).alias("document"), "d.start", "d.n_tokens")


def document_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write ``docs`` as token files to the shared folder and count from the files alone."""
    folder = fresh_folder(docs.sparkSession, "token-files")
    write_token_files(docs, folder, vocabulary)
    return counts(docs.sparkSession, folder).withColumn(
        "file", F.regexp_extract("file", "part-([0-9]+)", 1).cast("int"))
