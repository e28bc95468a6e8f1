"""Link documents whose word shingles overlap, and find the groups the links make.

Method: a token-group matrix. Shingles are tokens. Documents with like tokens form
groups of a bounded size; the matrix has the tokens of each group's members. A document
opens a group only if its overlap with the group's tokens, an upper bound of its overlap
with any member, can reach the limit, and only then meets the members.

What the matrix leaves out loses no link:
* Equal sets are one class, and only classes are compared.
* Two sets of similarity 3/4 share at least 3/4 of either. A class of whose tokens fewer
  occur in any other class has no link and drops out.
* With tokens ordered by frequency, then hash, two such sets share a token among the first
  quarter (and one more) of each. Only these tokens look up groups.
* Inside a component no link changes anything. After the groups are resolved by
  themselves, only classes that are still apart are compared, each from the smaller
  component's side, and every such pair that shares a looked-up token is compared.

A token is a 64-bit hash of its words. Between tasks 40 bits travel besides the number of
the token's range, of about two million tokens whatever the size of the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.common import OWN, by_batch, in_slices, own_hash, stored, with_facts, without
from tallygrid.llm.components import components
from tallygrid.llm.hashes import joined, lot_of, packed, shingles, split_by
from tallygrid.llm.tokens import forget as forget_tokens
from tallygrid.operators.spread import attach

WORDS = 5
PERCENT = 75
TOKENS_A_LOT = 2_000_000
GROUP = 256
BLOCK = 1024
_LOW = np.uint64((1 << 40) - 1)


def _class_of(tokens: np.ndarray) -> int:
    return int(np.array(xxhash.xxh3_64_intdigest(tokens.tobytes()), dtype=np.uint64).view(np.int64))


def _least_shared(n: np.ndarray | int, percent: int):
    """How many of a set's ``n`` tokens a set linked to it must have."""
    return -(-n * percent // 100)


def classes(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, hash of the text, n_shingles, and class (null without shingles) of each row."""

    def make():
        forget_tokens()

        def each(batch):
            for part in in_slices(batch, "text", 1 << 22):
                sets = [shingles(t, words) for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part[OWN], pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([_class_of(s) if len(s) else None for s in sets], pa.int64())],
                    names=["doc_id", OWN, "n_shingles", "class"])

        return each

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", own_hash(), F.col("text").cast("binary").alias("text")).mapInArrow(
        by_batch(make), f"doc_id {kind}, {OWN} long, n_shingles long, class long")


def _tokens_by_lot(words: int, lots: int):
    """Each slice's tokens by range, once for equal texts of the slice."""

    def make():
        def each(batch):
            for part in in_slices(batch, "text", 1 << 23):
                own = {}
                for text in part["text"].to_pylist():
                    tokens = shingles(text, words)
                    if len(tokens):
                        own[_class_of(tokens)] = tokens
                if not own:
                    continue
                names = np.array(list(own), dtype=np.int64)
                sizes = np.array([len(x) for x in own.values()], dtype=np.int64)
                tokens = np.concatenate(list(own.values()))
                owner = np.repeat(np.arange(len(names)), sizes)
                rows = []
                for lot, at in split_by(lot_of(tokens, lots)):
                    there, counts = np.unique(owner[at], return_counts=True)
                    low = tokens[at] & _LOW
                    rows.append((lot, packed(names[there], "<i8"), packed(sizes[there], "<u4"),
                                 packed(counts, "<u4"), packed(low & np.uint64(0xFFFFFFFF), "<u4"),
                                 packed(low >> np.uint64(32), "u1")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if i == 0 else pa.binary())
                     for i, c in enumerate(zip(*rows, strict=True))],
                    names=["lot", "classes", "sizes", "counts", "low", "high"])

        return each

    return by_batch(make)


def _frequencies(buckets: int):
    """Of a range's tokens, those that two or more classes have, dealt out by class."""

    def run(key, table):
        lot = key[0].as_py()
        counts = joined(table["counts"], "<u4")
        owner = np.repeat(joined(table["classes"], "<i8"), counts)
        size = np.repeat(joined(table["sizes"], "<u4"), counts)
        token = joined(table["low"], "<u4").astype(np.uint64) | (
            joined(table["high"], "u1").astype(np.uint64) << np.uint64(32))
        order = np.lexsort((owner, token))
        token, owner, size = token[order], owner[order], size[order]
        fresh = np.ones(len(token), dtype=bool)
        fresh[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
        token, owner, size = token[fresh], owner[fresh], size[fresh]
        begins = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        often = np.diff(np.r_[begins, len(token)])
        often = np.repeat(often, often)
        shared = often > 1
        token, owner, size, often = token[shared], owner[shared], size[shared], often[shared]
        rows = []
        for bucket, at in split_by((owner.view(np.uint64) % np.uint64(buckets)).astype(np.int32)):
            at = at[np.argsort(owner[at], kind="stable")]
            names, first, counts = np.unique(owner[at], return_index=True, return_counts=True)
            rows.append((bucket, lot, packed(names, "<i8"), packed(size[at][first], "<u4"), packed(counts, "<u4"),
                         packed(token[at] & np.uint64(0xFFFFFFFF), "<u4"),
                         packed(token[at] >> np.uint64(32), "u1"), packed(np.minimum(often[at], 65_535), "<u2")))
        columns = list(zip(*rows, strict=True)) or [()] * 8
        return pa.table([pa.array(c, pa.int32() if i < 2 else pa.binary()) for i, c in enumerate(columns)],
                        names=["bucket", "lot", "classes", "sizes", "counts", "low", "high", "often"])

    return run


def _possible(percent: int):
    """The classes that may have a link: their shared tokens by frequency, then hash."""

    def run(key, table):
        counts = joined(table["counts"], "<u4")
        owner = np.repeat(joined(table["classes"], "<i8"), counts)
        size = np.repeat(joined(table["sizes"], "<u4"), counts).astype(np.int64)
        lots = [lot for lot, c in zip(table["lot"].to_pylist(), table["counts"].to_pylist(), strict=True)
                for _ in range(int(np.frombuffer(c, "<u4").sum()))]
        token = joined(table["low"], "<u4").astype(np.uint64) | (
            joined(table["high"], "u1").astype(np.uint64) << np.uint64(32)) | (
            np.array(lots, dtype=np.uint64) << np.uint64(40))
        often = joined(table["often"], "<u2")
        order = np.lexsort((token, often, owner))
        token, owner, size = token[order], owner[order], size[order]
        begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, dtype=int)
        ends = np.r_[begins[1:], len(owner)]
        rows = []
        for b, e in zip(begins, ends, strict=False):
            n, shared = int(size[b]), int(e - b)
            least = int(_least_shared(n, percent))
            if shared >= least:
                looked_up = n - least + 1 - (n - shared)
                rows.append((int(owner[b]), n, looked_up, int(token[e - 1].view(np.int64)),
                             packed(token[b:e], "<u8")))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.table([pa.array(c, pa.binary() if i == 4 else pa.int64()) for i, c in enumerate(columns)],
                        names=["class", "n", "looked_up", "top", "tokens"])

    return run


class _Group:
    """Members of a group and which of them have each token."""

    def __init__(self, sizes: np.ndarray, tokens: list[np.ndarray], percent: int):
        self.sizes, self.percent = sizes, percent
        every = np.concatenate(tokens)
        owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
        order = np.argsort(every, kind="stable")
        self.owner = owner[order]
        self.union, self.begins = np.unique(every[order], return_index=True)
        self.ends = np.r_[self.begins[1:], len(every)]

    def linked(self, n: int, tokens: np.ndarray) -> np.ndarray:
        """The members linked to a set, if its overlap with the union allows any."""
        hit = np.isin(tokens, self.union, assume_unique=True)
        if hit.sum() < _least_shared(n, self.percent):
            return np.zeros(0, dtype=np.int64)
        at = np.searchsorted(self.union, tokens[hit])
        lengths = self.ends[at] - self.begins[at]
        places = np.repeat(self.begins[at] - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(lengths.sum())
        inter = np.bincount(self.owner[places], minlength=len(self.sizes))
        return np.flatnonzero(100 * inter >= self.percent * (n + self.sizes - inter))


def _sets(table) -> list[np.ndarray]:
    return [np.frombuffer(t, "<u8") for t in table["tokens"].to_pylist()]


def _within_group(percent: int):
    """Join a group's members by their links; the hub has the most links."""

    def run(key, table):
        names, sets = table["class"].to_numpy(), _sets(table)
        group = _Group(table["n"].to_numpy(), sets, percent)
        root = np.arange(len(names))
        links = np.zeros(len(names), dtype=np.int64)

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i, (n, tokens) in enumerate(zip(table["n"].to_pylist(), sets, strict=True)):
            near = group.linked(n, tokens)
            links[i] = len(near)
            mine = find(i)
            for j in near[near > i]:
                other = find(j)
                root[max(mine, other)] = min(mine, other)
                mine = min(mine, other)
        roots = np.array([find(i) for i in range(len(names))], dtype=np.int64)
        hub = np.lexsort((names, -links))[0]
        is_hub = np.arange(len(names)) == hub
        first = [t[: 8 * k] for t, k in zip(table["tokens"].to_pylist(), table["looked_up"].to_pylist(), strict=True)]
        return pa.table(
            [table["class"], table["n"], table["top"], table["chunk"], table["chunks"], table["group"],
             pa.array(names[roots]), pa.array(first, pa.binary()),
             pa.array([t if h else None for t, h in zip(table["tokens"].to_pylist(), is_hub, strict=True)], pa.binary())],
            names=["class", "n", "top", "chunk", "chunks", "group", "root", "first", "hub"])

    return run


def _same_hubs(percent: int):
    def make():
        def each(batch):
            linked = []
            for n, tokens, n0, tokens0 in zip(*(batch[c].to_pylist() for c in ("n", "tokens", "n0", "tokens0")),
                                              strict=True):
                inter = len(np.intersect1d(np.frombuffer(tokens, "<u8"), np.frombuffer(tokens0, "<u8"),
                                           assume_unique=True))
                linked.append(100 * inter >= percent * (n + n0 - inter))
            yield batch.select(["root", "root0"]).filter(pa.array(linked))

        return each

    return by_batch(make)


def _across(percent: int):
    """Links between a block of queries and the members of a group they open."""

    def run(key, members, queries):
        found = set()
        if members.num_rows and queries.num_rows:
            parts = members["part"].to_pylist()
            group = _Group(members["n"].to_numpy(), _sets(members), percent)
            for n, mine, tokens in zip(queries["n"].to_pylist(), queries["part"].to_pylist(), _sets(queries),
                                       strict=True):
                found.update((max(mine, parts[j]), min(mine, parts[j])) for j in group.linked(n, tokens)
                             if parts[j] != mine)
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _candidates(docs: DataFrame, n_tokens: int, words: int, percent: int) -> DataFrame:
    lots = max(8, -(-n_tokens // TOKENS_A_LOT))
    blobs = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(
        _tokens_by_lot(words, lots), "lot int, classes binary, sizes binary, counts binary, low binary, high binary")
    shared = blobs.groupBy("lot").applyInArrow(
        _frequencies(lots),
        "bucket int, lot int, classes binary, sizes binary, counts binary, low binary, high binary, often binary")
    return stored(shared.groupBy("bucket").applyInArrow(
        _possible(percent), "class long, n long, looked_up long, top long, tokens binary"), "jaccard-classes")


def class_links(possible: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(class, label): classes that links join have one label, one of those classes."""
    chunks = possible.groupBy("top").agg(F.ceil(F.count("*") / GROUP).alias("chunks"))
    placed = attach(possible.select("class", "top"), chunks, ["top"]).select(
        "class", "chunks", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int").alias("chunk"))
    grouped = stored(with_facts(possible, placed, ["class"]).withColumn(
        "group", F.xxhash64("top", "chunk")), "jaccard-groups")
    inside = stored(grouped.groupBy("group").applyInArrow(
        _within_group(percent),
        "class long, n long, top long, chunk int, chunks long, group long, root long, first binary, hub binary"),
        "jaccard-inside")

    # Groups of the same top token meet at the hub of one of them.
    hubs = inside.filter("chunks > 1 and hub is not null").select(
        "top", "chunk", "root", "n", F.col("hub").alias("tokens"))
    centre = hubs.groupBy("top").agg(F.min_by(F.struct("root", "n", "tokens"), "chunk").alias("x")).select(
        "top", F.col("x.root").alias("root0"), F.col("x.n").alias("n0"), F.col("x.tokens").alias("tokens0"))
    met = attach(hubs, centre, ["top"]).filter("root <> root0").mapInArrow(
        _same_hubs(percent), "root long, root0 long").dropDuplicates(["root"])
    known = with_facts(inside.select("class", "n", "group", "root", "first"), met, ["root"])
    known = known.select("class", "n", "group", "first", F.coalesce("root0", "root").alias("part"))
    sizes = known.groupBy("part").agg(F.count("*").alias("size"))
    parts = stored(attach(known, sizes, ["part"]), "jaccard-parts")

    # The matrix: which groups have a looked-up token, and what is in them.
    token = F.transform(F.sequence(F.lit(1), F.octet_length("first"), F.lit(8)), lambda i: F.substring(
        F.col("first"), i, F.lit(8)))
    looked = parts.select(F.explode(token).alias("token"), "class", "n", "group", "size", "part")
    matrix = looked.groupBy("token", F.col("group").alias("to")).agg(
        F.max(F.struct("size", "part")).alias("most"), F.min("n").alias("n_least"), F.max("n").alias("n_most"))
    opened = looked.join(matrix, "token").filter(
        (F.struct("size", "part") < F.col("most")) & (F.col("group") != F.col("to"))
        & (100 * F.col("n_most") >= percent * F.col("n")) & (percent * F.col("n_least") <= 100 * F.col("n")))
    pairs = stored(opened.select("class", F.col("to").alias("group")).distinct(), "jaccard-opened")

    blocks = pairs.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    light = parts.select("class", "group", "part")
    needed = attach(light, blocks, ["group"], "left_semi").unionByName(
        attach(light, pairs.select("class").distinct(), ["class"], "left_semi")).distinct()
    sets = stored(with_facts(grouped.select("class", "n", "tokens"), needed, ["class"], "inner"), "jaccard-sets")
    members = attach(sets, blocks, ["group"], "inner").select(
        "group", "n", "part", "tokens", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    queries = attach(pairs, blocks, ["group"]).select(
        "class", "group", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int").alias("block"))
    queries = attach(queries, sets.select("class", "n", "part", "tokens"), ["class"])
    queries = queries.toDF(*queries.columns)  # apart from the members, which come from the same table
    links = members.groupBy("group", "block").cogroup(queries.groupBy("group", "block")).applyInArrow(
        _across(percent), "a long, b long")
    merged = components(links).select(F.col("a").alias("part"), F.col("b").alias("label"))
    return attach(parts, merged, ["part"]).select("class", F.coalesce("label", "part").alias("label"))


def _labelled(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``classes`` of all rows, and the labels that links give to classes."""
    found = stored(classes(docs, words), "jaccard-documents")
    n_tokens = found.agg(F.sum("n_shingles")).first()[0] or 0
    return found, class_links(_candidates(docs, n_tokens, words, percent), percent)


def linked_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs``.

    Two documents link when ``percent`` of the union of their shingle sets is in both. The
    component is named by the smallest id that links reach. A text with fewer words has
    one shingle, all of them; null, empty and blank texts have none, link with nothing and
    keep their own id. Null ids name no component, and have null if no other id is
    reached. Repeated rows are equal sets. An empty table gives an empty result.
    """
    found, labels = _labelled(docs, words, percent)
    firsts = found.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("first"))
    known = attach(firsts, labels, ["class"])
    least = known.filter("label is not null").groupBy("label").agg(F.min("first").alias("least"))
    named = attach(known, least, ["label"]).select("class", F.coalesce("least", "first").alias("component_id"))
    return attach(found, named, ["class"]).select(
        "doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(
            F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that name their component, columns unchanged: of those that have
    the smallest id, or all of them none, that with the smallest hash of its text. Rows
    without shingles stay; of rows that repeat an id and its text, one does."""
    found, labels = _labelled(docs, words, percent)
    rows = stored(attach(found.filter("class is not null"), labels, ["class"]).select(
        "doc_id", OWN, F.coalesce("label", "class").alias("part")), "jaccard-result")
    best = rows.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", OWN)).alias("best"))
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col(OWN) == F.col(f"best.{OWN}"))
    gone = attach(rows, best, ["part"]).filter(~stays).select("doc_id", OWN).distinct()
    return without(docs, gone, found)
