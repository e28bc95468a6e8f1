"""Mix the sources of a corpus to target weights.

Method: a splitting tree of block quotas. Each source is cut into blocks by a hash
of the document id. A source's quota is whole blocks in a permuted order, and a part
of one more. The quota's block copies go down a binary tree: at each node they are
put in an order of that node's own and halved, which draws the left half's counts by
source from the multivariate hypergeometric distribution and leaves the rest to the
right. The leaves are the output shards; each shuffles its own documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.llm.common import OWN, ROW, n_words, own_hash, stored, with_facts, with_row

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BLOCKS = 1024  # of a source at least
DOCUMENTS = 8192  # of a block at most, on average, as the table grows
SHARD_WORDS = 4_000_000  # of an output shard at most
PLACED = 200_000  # block copies that one task puts in order
SEED = 20


def _order(*parts: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *parts)


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """Words wanted of each source, from (source, source_size) with one row a source.

    Sources in code point order, null last, get the weights in turn. Together the
    targets are ``share`` of all words, none above ``most`` times its source's size.
    What a capped source cannot take goes to the others by weight: with sources in
    order of size per weight, a source is capped if its cap is at most its share of
    what the sources before it leave. The windows hold one row a source.
    """
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights)) + 1)
    by_room = Window.orderBy(F.col("__cap") / F.col("__weight"), F.asc_nulls_last("source"))
    earlier = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()

    def before(name: str) -> Column:
        return F.coalesce(F.sum(name).over(earlier), F.lit(0.0))

    def capped(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("__capped"), F.col(name))).over(everyone), F.lit(0.0))

    wanted = F.sum("source_size").over(everyone) * share
    weighed = (
        sizes.withColumn("__weight", weight)
        .withColumn("__cap", F.col("source_size") * most)
        .withColumn("__wanted", wanted)
        .withColumn("__weights", F.sum("__weight").over(everyone))
    )
    fair = F.col("__weight") * (F.col("__wanted") - before("__cap")) / (
        F.col("__weights") - before("__weight"))
    marked = weighed.withColumn("__capped", F.col("__cap") <= fair)
    left = F.col("__weight") * (F.col("__wanted") - capped("__cap")) / F.nullif(
        F.col("__weights") - capped("__weight"), F.lit(0.0))
    target = F.when(F.col("__capped"), F.col("__cap")).otherwise(F.least(left, F.col("__cap")))
    return marked.select("source", "source_size", target.alias("target"))


def _quotas(per_block: DataFrame, wanted: DataFrame, seed: int) -> DataFrame:
    """For each block: ``full`` copies of all of it, and how many words of one copy
    more (``extra_left``: null none, else the words the quota has left for it)."""
    quota = F.floor(F.col("target") + 0.5)
    some = F.col("source_size") > 0
    full = F.when(some, F.floor(quota / F.col("source_size"))).otherwise(0)
    in_order = (
        Window.partitionBy("source")
        .orderBy(_order("source", "block", seed=seed), "block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        with_facts(per_block, wanted, ["source"])
        .withColumn("full", full)
        .withColumn("__rest", F.when(some, quota - F.col("full") * F.col("source_size")).otherwise(0))
        .withColumn("__left", F.col("__rest") - F.coalesce(F.sum("words").over(in_order), F.lit(0)))
        .withColumn("extra_left", F.when((F.col("__left") > 0) & (F.col("words") > 0), F.col("__left")))
        .drop("__rest", "__left")
    )


def _power_of_two(least: int) -> int:
    return 1 << max(0, least - 1).bit_length()


def _halved(units: DataFrame, level: int, many: int, seed: int) -> DataFrame:
    """Send the block copies of each node to its left or right child, half each, by an
    order of the node's own. Where a node has more than ``PLACED`` copies (of ``many`` in
    the level's largest), they are ranked within ranges of the order, and ranges are counted."""
    place = _order("source", "block", "copy", seed=seed + level)
    node = Window.partitionBy("node")
    if many <= PLACED:
        drawn = node.orderBy(place, "source", "block", "copy")
        right = (F.row_number().over(drawn) * 2 > F.count("*").over(node) + 1).cast("int")
        return units.withColumn("node", F.col("node") * 2 + right)
    ranges = _power_of_two(-(-many // PLACED))
    ranged = units.withColumn("__range", F.shiftright(place, 64 - ranges.bit_length() + 1) if ranges > 1 else F.lit(0))
    counts = ranged.groupBy("node", "__range").agg(F.count("*").alias("__n"))
    before = node.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).withColumn(
        "__all", F.sum("__n").over(node)).drop("__n")
    inside = Window.partitionBy("node", "__range").orderBy(place, "source", "block", "copy")
    rank = F.col("__before") + F.row_number().over(inside)
    right = (rank * 2 > F.col("__all") + 1).cast("int")
    return ranged.join(counts, ["node", "__range"]).withColumn("__right", right).select(
        "source", "block", "copy", (F.col("node") * 2 + F.col("__right")).alias("node"))


def _shards(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """The shard of each copy of each block: (source, block, shards), one entry a copy."""
    copies = F.col("full") + F.col("extra_left").isNotNull().cast("long")
    units = quotas.filter((copies > 0) & (F.col("words") > 0)).select(
        "source", "block", F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("copy"),
        F.lit(0).alias("node"))
    many = units.count() if shards > 1 else 0
    for level in range(1, shards.bit_length()):
        units = _halved(units, level, many, seed)
        many = -(-many // 2)
    return units.groupBy("source", "block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("copy", "node"))), lambda x: x["node"]).alias(
            "shards"))


def _planned(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
             blocks: int | None = None, shards: int | None = None, seed: int = SEED, whole: bool = False) -> DataFrame:
    """``mix`` with the source and the hash of the text of each row. ``whole``: documents at
    the edge of a quota are taken whole or left, whichever is nearer to it."""
    # A null id hashes as nothing: rows without an id are told apart by their texts.
    alone = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    sized = stored(
        docs.select("doc_id", own_hash(), "source", n_words(F.col("text")).alias("size"),
                    _order("doc_id", alone, seed=seed).alias("spot")), "mix-sizes")
    rows, words = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    if blocks is None:
        blocks = max(BLOCKS, _power_of_two(-(-rows // DOCUMENTS)))
    if shards is None:
        shards = _power_of_two(-(-int(words * share) // SHARD_WORDS))
    sized = sized.withColumn("block", F.pmod("spot", F.lit(blocks)).cast("int")).drop("spot")
    per_block = stored(
        sized.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    sizes = per_block.groupBy("source").agg(F.sum("words").alias("source_size"))
    quotas = stored(_quotas(per_block, targets(sizes, weights, share, most), seed), "mix-quotas")
    drawn = with_facts(quotas, _shards(quotas, shards, seed), ["source", "block"])
    placed = with_facts(sized, drawn, ["source", "block"])
    edge = F.coalesce(F.col("extra_left") < F.col("words"), F.lit(False))
    earlier = (
        Window.partitionBy("source")
        .orderBy(_order("doc_id", F.when(F.col("doc_id").isNull(), F.col(OWN)), seed=seed + 1), "doc_id", "size", OWN)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inner = placed.filter(~edge).withColumn(
        "extra", F.when(F.col("extra_left").isNotNull(), F.col("size")).otherwise(0))
    room = F.col("extra_left") - F.coalesce(F.sum("size").over(earlier), F.lit(0))
    extra = F.least(F.col("size"), F.greatest(room, F.lit(0)))
    if whole:
        extra = F.when(extra * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0))
    cut = placed.filter(edge).withColumn("extra", extra)
    taken = F.col("full") * F.col("size") + F.col("extra")
    copies = (F.when(F.col("size") > 0, F.col("full")).otherwise(0) + (F.col("extra") > 0).cast("int")).cast("int")
    return inner.unionByName(cut).select(
        "doc_id", OWN, "source", "size", "source_size", "target", taken.cast("long").alias("taken"),
        F.coalesce(F.slice("shards", F.lit(1), copies), F.array().cast("array<int>")).alias("shards"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
        blocks: int | None = None, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """How many words of each document the mix takes, and into which shards.

    Columns: doc_id, size, source_size, target (the source's), taken (words, repeats
    counted), shards (one entry for each copy taken, the last of which may be cut).
    One row for each row of ``docs``. A source's taken words equal its rounded target:
    the document at the edge of the quota gives its first words only, at most one
    document a source. Choices depend on ids, texts, sources and sizes alone, so reruns agree.

    ``blocks`` a source bounds all that is ordered in one task: the block table has
    ``blocks`` rows a source, and documents are ordered in one block a source. ``shards``
    is a power of two. Both grow with the table unless they are given. Null text and text without words have size 0 and are not taken;
    a null source is a source; a null id is an id; repeated rows are rows of their own.
    An empty table gives an empty result. Only doc_id, text and source are read.
    """
    return _planned(docs, weights, share, most, blocks, shards, seed).drop(OWN, "source")


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: a row of ``docs``, with its columns, for each copy taken, dealt
    out by shard and shuffled inside each. No text is cut: at the edge of a source's quota
    a document is taken whole or left, whichever is nearer. Rows that repeat an id are
    given as often as they stand."""
    keys = ["doc_id", OWN, "source"]
    copies = _planned(docs, whole=True, **how).filter(F.size("shards") > 0).select(
        *keys, F.posexplode("shards").alias("__copy", "__shard"))
    # Rows that are equal by all keys share one text, which their copies are joined to.
    marked = with_row(docs, "source")
    if not marked.groupBy(*keys).count().filter("count > 1").isEmpty():
        marked = marked.dropDuplicates(keys)
    rows = with_facts(marked, copies, keys, "inner")
    seed = how.get("seed", SEED)
    shards = 1 + (copies.agg(F.max("__shard")).first()[0] or 0)
    return (
        rows.repartitionById(shards, F.col("__shard"))
        .sortWithinPartitions("__shard", _order("doc_id", OWN, "__copy", seed=seed))
        .select(f"{ROW}.*")
    )
