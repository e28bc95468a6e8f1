"""Find texts that are equal up to white space.

Method: progressive refinement. Documents are grouped by length, those that share a
length by a hash of their first characters, and only those that share that too by a
hash of the whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.common import OWN, own_hash, stored, without, without_blanks
from tallygrid.operators.spread import attach

PREFIX = 64
FILTER_WORDS = 1 << 19  # of 64 bits, at most: 4 MB
LOAD = 8  # bits of the filter for each key, at least


def _shared(rows: DataFrame, *keys: str) -> DataFrame:
    """The keys that more than one row has."""
    return rows.groupBy(*keys).agg(F.count("*").alias("__n")).filter("__n > 1").drop("__n")


def _spot(words: int) -> Column:
    return F.pmod(F.xxhash64("length", "start"), F.lit(words * 64))


def _filter_bits(keys: DataFrame, words: int) -> DataFrame:
    """One row, one array of ``words`` longs in which the keys' bits are set."""
    set_bits = keys.select(_spot(words).alias("spot")).select(
        F.floor(F.col("spot") / 64).cast("long").alias("word"),
        F.expr("shiftleft(1L, cast(spot % 64 as int))").alias("bit"))
    no_bits = keys.sparkSession.range(words).select(
        F.col("id").alias("word"), F.lit(0).cast("long").alias("bit"))
    joined = no_bits.unionByName(set_bits).groupBy("word").agg(F.bit_or("bit").alias("bit"))
    in_order = F.array_sort(F.collect_list(F.struct("word", "bit")))
    return joined.agg(F.transform(in_order, lambda x: x["bit"]).alias("bits"))


def hashed(docs: DataFrame) -> DataFrame:
    """doc_id, hash of the text, text_sha256 of the text without white space, and code
    points of the text."""
    return docs.select(
        "doc_id", own_hash(), F.sha2(without_blanks(F.col("text")).cast("binary"), 256).alias("text_sha256"),
        F.coalesce(F.length("text"), F.lit(0)).alias("points"))


def possible_copies(docs: DataFrame, prefix: int = PREFIX, filter_words: int = FILTER_WORDS) -> DataFrame:
    """``hashed`` for the documents that share length and prefix with another one, and
    for the few that only fall on a bit that another (length, prefix) has set.

    The filter has ``LOAD`` bits or more for each shared key. Where that would take more
    than ``filter_words``, documents are joined with the keys instead."""
    bare = without_blanks(F.col("text"))
    sketch = (F.length(bare).alias("length"), F.xxhash64(F.substring(bare, 1, prefix)).alias("start"))
    light = stored(docs.select(*sketch), "exact-sketches")
    same_length = attach(light, _shared(light, "length"), ["length"], "left_semi")
    keys = stored(_shared(same_length, "length", "start"), "exact-keys")
    words = 1 << max(6, (keys.count() * LOAD // 64).bit_length())
    texts = docs.select("doc_id", "text", *sketch)
    if words > filter_words:
        return hashed(attach(texts, keys, ["length", "start"], "left_semi"))
    bits = stored(_filter_bits(keys, words), "exact-filter")
    marked = texts.withColumn("__spot", _spot(words)).withColumn(
        "__word", F.element_at(bits.scalar(), (F.floor(F.col("__spot") / 64) + 1).cast("int")))
    return hashed(marked.filter("shiftright(__word, cast(__spot % 64 as int)) & 1 = 1"))


def copy_groups(candidates: DataFrame) -> DataFrame:
    """Groups of two or more equal texts: text_sha256, keep_id, keep_own and group_size.

    Of a group the row with the most code points in its original text stays, then the
    smallest doc_id; a null id comes last. Null text counts as empty, and empty texts
    are equal. Repeated rows count as rows.
    """
    best = F.min(F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("none"), "doc_id", OWN))
    return (
        candidates.groupBy("text_sha256")
        .agg(F.count("*").alias("group_size"), best.alias("best"))
        .filter("group_size > 1")
        .select("text_sha256", F.col("best.doc_id").alias("keep_id"), F.col(f"best.{OWN}").alias("keep_own"), "group_size")
    )


def exact_copies(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row of ``docs``.

    One row of each group is kept. Of rows that are alike in id and text one is, whichever;
    of rows with one id, as many code points and different white space, the one with the
    smaller hash. Rows are counted before they are joined, so that copies of a row travel
    once. The first pass over the texts shuffles lengths and prefix hashes, the second hashes
    in full what the first could not tell apart. The hash of texts without a copy is worked
    out for the report alone. An empty table gives an empty result.
    """
    groups = copy_groups(possible_copies(docs))
    alike = hashed(docs).groupBy("doc_id", OWN, "text_sha256").agg(F.count("*").alias("__times"))
    found = attach(alike, groups, ["text_sha256"])
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    best = alone | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col(OWN) == F.col("keep_own")))
    return found.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        best.alias("best"), "text_sha256", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times"))).alias("place")).select(
        "doc_id", "keep_id", "group_size", (F.col("best") & (F.col("place") == 1)).alias("kept"), "text_sha256")


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged; of rows that repeat an id and its
    text, one."""
    candidates = stored(possible_copies(docs), "exact-candidates")
    found = attach(candidates, copy_groups(candidates), ["text_sha256"], "inner")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col(OWN) == F.col("keep_own"))
    gone = found.filter(~stays).select("doc_id", OWN).distinct()
    return without(docs, gone, candidates)
