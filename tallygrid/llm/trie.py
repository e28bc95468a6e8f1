"""The trie of all conversation prefixes, with totals over each subtree.

Method: time-forward processing. Nodes are put in reverse level order by an external sort,
and each passes its subtree's total on to its parent through a priority queue that spills,
so that a node finds what its children sent when its turn comes. That is done within
shards first, and then across the roots of the shards.

A node stands for the turns up to some depth, told apart by two 64-bit hashes: the sum of
each turn's hash times a base to the power of its depth. Sums can be carried from one part
of a long conversation to the next, and moved by a depth or two, without its texts.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.common import by_batch, stored
from tallygrid.operators.spread import attach

GROUP = 100
HEAD = 6  # a conversation takes up to HEAD - 1 first turns from its group's first one
SHARED_TOP = 100_000  # nodes, at most so many, that belong to no shard
CROWD = 64  # a tree with fewer members is never split
QUEUE = 200_000  # messages that a queue holds in memory
CHUNK = 1 << 13  # bytes of conversation ids that travel as one row
# Odd bases of the two hashes.
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))

_PLACED = "lot int, conv_id long, pos long, points long, q1 long, q2 long, r1 long, r2 long"
_ROW = "conv_id long, depth long, p1 long, p2 long, u1 long, u2 long, points long, last boolean"


def _power(base: np.uint64, exponents: np.ndarray) -> np.ndarray:
    """base to each exponent, modulo 2 ** 64; exponents may be negative."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    out = np.ones(len(exponents), dtype=np.uint64)
    left = np.abs(exponents)
    square = np.where(exponents < 0, inverse, base)
    while left.any():
        out = np.where(left & 1, out * square, out)
        square, left = square * square, left >> 1
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _numbered(batches):
    """Turns in order, each as often as it stands, with its place in its conversation and
    the hashes of all turns up to it (q) and before it (r), both within the task."""
    conv, at, sums = None, 0, np.zeros(2, dtype=np.uint64)
    for batch in batches:
        times = batch["times"].to_numpy()
        total = np.cumsum(times)
        for begin in range(0, int(total[-1]) if len(total) else 0, 1 << 16):
            rows = np.searchsorted(total, np.arange(begin, min(begin + (1 << 16), int(total[-1]))), side="right")
            part = batch.take(pa.array(rows))
            convs = part["conv_id"].to_numpy()
            first = np.concatenate([[True], convs[1:] != convs[:-1]])
            runs = np.flatnonzero(first)
            run = np.cumsum(first) - 1
            pos = np.arange(len(convs)) - runs[run] + 1
            goes_on = conv is not None and convs[0] == conv
            if goes_on:
                pos[run == 0] += at
            hashes = []
            for k, base in enumerate(BASES):
                own = _unsigned(part[f"t{k + 1}"]) * _power(base, pos)
                through = np.cumsum(own, dtype=np.uint64)
                before = (through - own)[runs]
                if goes_on:
                    before[:1] -= sums[k : k + 1]
                q = through - before[run]
                hashes += [q, q - own]
                sums[k] = q[-1]
            conv, at = convs[-1], int(pos[-1])
            q1, r1, q2, r2 = hashes
            yield pa.RecordBatch.from_arrays(
                [part["lot"], part["conv_id"], pa.array(pos), part["points"], *map(_signed, (q1, q2, r1, r2))],
                names=["lot", "conv_id", "pos", "points", "q1", "q2", "r1", "r2"])


def _carried(ends: list) -> dict[int, tuple[int, int, int, int]]:
    """For each task whose first conversation began in an earlier one: that conversation,
    how many turns it had so far, and their hashes."""
    carries, held = {}, None
    for r in ends:
        lot, first, (last, pos, q1, q2) = r["lot"], r["first"], r["end"]
        q = [x % (1 << 64) for x in (q1, q2)]
        if held is not None and held[0] == first:
            carries[lot] = held
            if last == first:
                moved = [(h + x * pow(int(b), held[1], 1 << 64)) % (1 << 64)
                         for h, x, b in zip(held[2:], q, BASES, strict=True)]
                held = (last, held[1] + pos, *moved)
                continue
        held = (last, pos, *q)
    return carries


def _with_carries(carries: dict[int, tuple[int, int, int, int]]):
    def make():
        def each(batch):
            lots, convs = batch["lot"].to_numpy(), batch["conv_id"].to_numpy()
            columns = {c: batch[c] for c in batch.schema.names}
            for lot in set(np.unique(lots).tolist()) & carries.keys():
                conv, n, *held = carries[lot]
                same = (lots == lot) & (convs == conv)
                columns["pos"] = pa.array(columns["pos"].to_numpy() + np.where(same, n, 0))
                for k, base in enumerate(BASES):
                    move = np.where(same, np.uint64(pow(int(base), n, 1 << 64)), np.uint64(1))
                    add = np.where(same, np.uint64(held[k]), np.uint64(0))
                    for name in (f"q{k + 1}", f"r{k + 1}"):
                        columns[name] = _signed(_unsigned(columns[name]) * move + add)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        return each

    return by_batch(make)


def placed_turns(turns: DataFrame) -> DataFrame:
    """lot, conv_id, pos (from 1), points (code points of the text), and the hashes through
    (q1, q2) and before (r1, r2) each turn of the conversations as they stand.

    Turns are ordered by turn, null first, and equal turns by a hash of role and text. Equal
    rows are counted before they are sorted, and a sort by ranges may cut a conversation, so
    that no conversation and no repeated row has to fit one task.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    light = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.length(text).cast("long").alias("points"),
        F.xxhash64(F.lit(1), role, text).alias("t1"), F.xxhash64(F.lit(2), role, text).alias("t2"))
    keys = ["conv_id", "turn", "t1", "t2", "points"]
    counted = light.groupBy(*keys).agg(F.count("*").alias("times"))
    order = ["conv_id", F.asc_nulls_first("turn"), "t1", "t2", "points"]
    local = stored(
        counted.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("lot", F.spark_partition_id()).mapInArrow(_numbered, _PLACED), "trie-turns")
    last = F.max_by(F.struct("conv_id", "pos", "q1", "q2"), F.struct("conv_id", "pos"))
    ends = local.groupBy("lot").agg(F.min("conv_id").alias("first"), last.alias("end")).orderBy("lot").collect()
    return stored(local.mapInArrow(_with_carries(_carried(ends)), _PLACED), "trie-placed")


def _moved(batches):
    """Rows of rebuilt conversations from their own turns after the head."""
    for batch in batches:
        if not batch.num_rows:
            continue
        shift = batch["k"].to_numpy() - batch["head"].to_numpy()
        hashes = []
        for k, base in enumerate(BASES, 1):
            move = _power(base, shift)
            hashes.append([_signed(_unsigned(batch[f"b{k}"]) + (_unsigned(batch[f"{x}{k}"]) - _unsigned(batch[f"o{k}"])) * move)
                           for x in "qr"])
        depth = batch["pos"].to_numpy() + shift
        (p1, u1), (p2, u2) = hashes
        yield pa.RecordBatch.from_arrays(
            [batch["conv_id"], pa.array(depth), p1, p2, u1, u2, batch["points"],
             pc.equal(batch["pos"], batch["n"])],
            names=["conv_id", "depth", "p1", "p2", "u1", "u2", "points", "last"])


def rebuilt(placed: DataFrame, group: int = GROUP, head: int = HEAD) -> DataFrame:
    """A row for the root and each turn of every rebuilt conversation: conv_id, depth, hashes
    of the turns through (p) and before (u) it, points, and whether it is the last.

    Conversation c has the first h turns of c - c % ``group``, all if it has fewer, and then
    its own turns after its first h; h is crc32 of c's digits, modulo ``head``.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % head).cast("long")
    first = F.col("conv_id") - F.col("conv_id") % group
    convs = placed.groupBy("conv_id").agg(F.max("pos").alias("n")).withColumn("head", h).withColumn("base", first)
    heads = stored(placed.filter(F.col("pos") < head), "trie-heads")
    entry = F.struct("pos", "points", *(x + k for x in "qr" for k in "12"))
    bases = heads.filter(F.col("conv_id") == first).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(entry)).alias("turns"))
    own = heads.filter(F.col("pos") == h).select("conv_id", F.col("q1").alias("o1"), F.col("q2").alias("o2"))
    k = F.least("head", F.coalesce(F.size("turns"), F.lit(0)).cast("long"))
    zero = F.lit(0).cast("long")
    facts = convs.join(bases, "base", "left").withColumn("turns", F.slice(
        F.coalesce("turns", F.array().cast("array<struct<pos:bigint,points:bigint,q1:bigint,q2:bigint,r1:bigint,r2:bigint>>")),
        F.lit(1), k.cast("int"))).withColumn("k", F.size("turns").cast("long")).join(own, "conv_id", "left")
    through = F.when(F.col("k") > 0, F.element_at("turns", F.greatest(F.col("k"), F.lit(1)).cast("int")))
    facts = stored(facts.select(
        "conv_id", "n", "head", "k", "turns", *(F.coalesce(through[f"q{i}"], zero).alias(f"b{i}") for i in (1, 2)),
        *(F.coalesce(f"o{i}", zero).alias(f"o{i}") for i in (1, 2))), "trie-facts")
    length = F.col("k") + F.greatest(F.col("n") - F.col("head"), zero)
    root = facts.select("conv_id", zero.alias("depth"), *(zero.alias(x) for x in ("p1", "p2", "u1", "u2", "points")),
                        (length == 0).alias("last"))
    taken = facts.select("conv_id", F.explode("turns").alias("x"), length.alias("length")).select(
        "conv_id", F.col("x.pos").alias("depth"), F.col("x.q1").alias("p1"), F.col("x.q2").alias("p2"),
        F.col("x.r1").alias("u1"), F.col("x.r2").alias("u2"), F.col("x.points").alias("points"),
        (F.col("x.pos") == F.col("length")).alias("last"))
    # Most turns are kept: the few facts of a conversation go to its turns, however many they are.
    kept = attach(placed.filter(F.col("pos") > h), facts.drop("turns"), ["conv_id"], "inner").mapInArrow(_moved, _ROW)
    return stored(root.unionByName(taken).unionByName(kept), "trie-rows")


def _hashed_ends(batches):
    """Rows (depth, p1, p2, lot, part, digest, ids): for each node, the SHA-256 of its ids;
    for a task's first and last node, which other tasks may have too, the ids in chunks."""
    node, waiting, part, lot, inner = None, b"", 0, 0, False
    out: list[tuple] = []

    def closed(last: bool):
        if node is None:
            return
        if inner and not last:
            out.append((*node, lot, 0, hashlib.sha256(waiting).hexdigest(), None))
        else:
            for k, at in enumerate(range(0, len(waiting), CHUNK)):
                out.append((*node, lot, part + k, None, waiting[at : at + CHUNK]))

    def batch_of(rows):
        columns = zip(*rows, strict=True)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                          names=["depth", "p1", "p2", "lot", "part", "digest", "ids"])

    for batch in batches:
        if not batch.num_rows:
            continue
        lot = batch["lot"][0].as_py()
        keys = np.stack([batch[c].to_numpy() for c in ("depth", "p1", "p2")])
        begins = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [batch.num_rows]])
        ids = batch["conv_id"].cast(pa.string())
        for a, b in zip(begins.tolist(), begins[1:].tolist(), strict=False):
            key = tuple(keys[:, a].tolist())
            text = ",".join(ids.slice(a, b - a).to_pylist()).encode()
            if key != node:
                closed(False)
                inner = node is not None
                node, waiting, part = key, text, 0
            else:
                waiting += b"," + text
            while len(waiting) > 4 * CHUNK:  # a node with many ids is handed on in chunks
                inner = False
                out.append((*node, lot, part, None, waiting[:CHUNK]))
                waiting, part = waiting[CHUNK:], part + 1
            if len(out) >= 2000:
                yield batch_of(out)
                out.clear()
    closed(True)
    if out:
        yield batch_of(out)


def _joined_ends(batches):
    """SHA-256 of the ids of nodes whose chunks come in order; tasks' ids are joined by a comma."""
    node = sha = lot = None
    out: list[tuple] = []
    for batch in batches:
        for d, p1, p2, its_lot, ids in zip(*(batch[c].to_pylist() for c in ("depth", "p1", "p2", "lot", "ids")),
                                           strict=True):
            if (d, p1, p2) != node:
                if node is not None:
                    out.append((*node, sha.hexdigest()))
                node, sha, lot = (d, p1, p2), hashlib.sha256(), its_lot
            elif its_lot != lot:
                sha.update(b",")
                lot = its_lot
            sha.update(ids)
    if node is not None:
        out.append((*node, sha.hexdigest()))
    for at in range(0, len(out), 10_000):
        d, p1, p2, digest = zip(*out[at : at + 10_000], strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(d, pa.int64()), pa.array(p1, pa.int64()), pa.array(p2, pa.int64()), pa.array(digest, pa.string())],
            names=["depth", "p1", "p2", "digest"])


def ends(rows: DataFrame) -> DataFrame:
    """depth, p1, p2 and digest of each node that a conversation ends at: the SHA-256 of
    those conversations' ids, ascending, joined by commas.

    Ids are sorted by ranges of node and id, so that many tasks spell out the ids of a node
    with many; only the text of nodes at a task's edge, in chunks, goes through one task.
    """
    order = ["depth", "p1", "p2", "conv_id"]
    spelled = stored(
        rows.filter("last").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("lot", F.spark_partition_id())
        .mapInArrow(_hashed_ends, "depth long, p1 long, p2 long, lot int, part long, digest string, ids binary"),
        "trie-ends")
    whole = spelled.filter(F.col("digest").isNotNull()).select("depth", "p1", "p2", "digest")
    cut = spelled.filter(F.col("digest").isNull()).repartition("depth", "p1", "p2").sortWithinPartitions(
        "depth", "p1", "p2", "lot", "part").mapInArrow(_joined_ends, "depth long, p1 long, p2 long, digest string")
    return whole.unionByName(cut)


class SpillingQueue:
    """A priority queue of (key, values) that keeps ``most`` entries in memory. Beyond that
    the larger half goes to a sorted run in an unnamed file of the task, read back as it is
    needed. Keys are tuples of numbers."""

    def __init__(self, most: int = QUEUE):
        self.most, self.heap, self.runs = most, [], []

    def push(self, *entry: int) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.most:
            self.heap.sort()
            keep = len(self.heap) // 2
            file = tempfile.TemporaryFile()
            np.array(self.heap[keep:], dtype=np.int64).tofile(file)
            del self.heap[keep:]
            file.seek(0)
            self._refill(file, len(entry))

    def _refill(self, file, width: int) -> None:
        """The next entries of a run come into memory, behind their first one in ``runs``."""
        block = np.fromfile(file, dtype=np.int64, count=width * 1024).reshape(-1, width).tolist()
        if block:
            heapq.heappush(self.runs, (tuple(block[0]), id(file), iter(map(tuple, block[1:])), file))
        else:
            file.close()

    def least(self) -> tuple[int, ...] | None:
        own, run = (self.heap[0] if self.heap else None), (self.runs[0][0] if self.runs else None)
        return run if own is None or (run is not None and run < own) else own

    def pop(self) -> tuple[int, ...]:
        if not self.runs or (self.heap and self.heap[0] <= self.runs[0][0]):
            return heapq.heappop(self.heap)
        entry, number, rest, file = heapq.heappop(self.runs)
        following = next(rest, None)
        if following is None:
            self._refill(file, len(entry))
        else:
            heapq.heappush(self.runs, (following, number, rest, file))
        return entry


def _forward(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds to each node's own leaves and saved what its children send. Nodes come by
    falling depth, then hashes; ``top`` marks those that send nothing within the task."""

    def run(batches):
        queue = SpillingQueue(most)
        for batch in batches:
            if not batch.num_rows:
                continue
            leaves, saved = [], []
            for depth, p1, p2, u1, u2, own, tokens, top in zip(
                    *(batch[c].to_pylist() for c in ("depth", "p1", "p2", "u1", "u2", "leaves", "saved", "top")),
                    strict=True):
                me = (-depth, p1, p2)
                while (sent := queue.least()) is not None and sent[:3] <= me:
                    if sent[:3] != me:
                        raise ValueError("a message for a node that is not here")
                    *_, more, spared = queue.pop()
                    own, tokens = own + more, tokens + spared
                if not top:
                    queue.push(1 - depth, u1, u2, own, tokens)
                leaves.append(own)
                saved.append(tokens)
            columns = {c: batch[c] for c in batch.schema.names}
            columns["leaves"], columns["saved"] = pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _totals(nodes: DataFrame, rows: DataFrame, shared_top: int, crowd: int, queue: int) -> DataFrame:
    """``nodes`` that two or more conversations share, with leaves and saved of their subtrees.

    The top of the trie is every node with ``crowd`` members or more, or so many that there
    are at most ``shared_top`` such nodes. Whatever hangs from the top is the root of a shard's tree; a
    tree is in one shard, a shard has many trees.
    """
    crowd = max(2, crowd, -(-rows.count() // shared_top))
    key, above = ["depth", "p1", "p2"], [(F.col("depth") - 1).alias("depth"), F.col("u1").alias("p1"), F.col("u2").alias("p2")]
    top = stored(nodes.filter((F.col("n_convs") >= crowd) | (F.col("depth") == 0)), "trie-top")
    named = F.broadcast(top.select(*key))  # at most shared_top rows, and the root
    below = nodes.filter((F.col("n_convs") < crowd) & (F.col("depth") > 0))
    roots = stored(below.join(named.select(
        F.col("depth").alias("td"), F.col("p1").alias("u1"), F.col("p2").alias("u2")),
        ["u1", "u2"]).filter("depth = td + 1").select(*key), "trie-roots")
    # Each conversation has at most one shard root among its nodes.
    label = rows.join(named, key, "left_anti").join(roots, key, "left_semi").select("conv_id", F.xxhash64(*key).alias("tree"), F.col("depth").alias("root_depth"))
    sharded = attach(below, label, ["conv_id"], "inner")
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
    inner = stored(
        sharded.withColumn("top", F.col("depth") == F.col("root_depth")).drop("root_depth")
        .repartition("tree").sortWithinPartitions(F.desc("depth"), "p1", "p2")
        .mapInArrow(_forward(queue), f"{shape}, tree long, top boolean").drop("tree"), "trie-shards")
    sent = inner.filter("top").select(*above, "leaves", "saved").groupBy(*key).agg(
        F.sum("leaves").alias("more"), F.sum("saved").alias("spared"))
    upper = (
        top.join(sent, key, "left").withColumn("leaves", F.col("leaves") + F.coalesce("more", F.lit(0)))
        .withColumn("saved", F.col("saved") + F.coalesce("spared", F.lit(0))).drop("more", "spared")
        .withColumn("top", F.col("depth") == 0)
        .repartition(1).sortWithinPartitions(F.desc("depth"), "p1", "p2")
        .mapInArrow(_forward(queue), f"{shape}, top boolean"))
    return inner.unionByName(upper).drop("top")


def prefix_trie(turns: DataFrame, group: int = GROUP, head: int = HEAD, shared_top: int = SHARED_TOP,
                crowd: int = CROWD, queue: int = QUEUE) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations (see ``rebuilt``): conv_id
    (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.

    A node is a distinct sequence of first turns, the root the empty one; its members are
    the conversations that begin with it. ``n_leaves`` and ``saved_tokens`` are sums over
    its subtree: of childless nodes, and of (members - 1) times the code points of a node's
    last text. Null roles and texts are empty, rows without a conv_id belong to no
    conversation, and equal turns of one are ordered as ``placed_turns`` says. An empty
    table has no conversation, hence no node, not even a root. Other columns are ignored.

    A node with one member has one leaf and saves nothing, so only shared nodes take part
    in the passing of totals. Sums and counts are made before rows meet: a first turn
    that a third of all conversations have is one row from each task.
    """
    rows = rebuilt(placed_turns(turns), group, head)
    key = ["depth", "p1", "p2"]
    above = [(F.col("depth") - 1).alias("depth"), F.col("u1").alias("p1"), F.col("u2").alias("p2")]
    bare = stored(rows.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("u1").alias("u1"),
        F.min("u2").alias("u2"), F.max("points").alias("points")), "trie-bare")
    children = bare.filter("depth > 0").select(*above, F.col("n_convs")).groupBy(*key).agg(
        F.count("*").alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("alone"))
    zero = F.lit(0).cast("long")
    known = bare.join(children, key, "left").withColumns(
        {"n_children": F.coalesce("n_children", zero), "alone": F.coalesce("alone", zero)})
    nodes = stored(known.withColumns({
        "leaves": F.when((F.col("n_children") == 0) | ((F.col("n_convs") == 1) & (F.col("depth") > 0)), 1).otherwise(
            F.col("alone")).cast("long"),
        "saved": (F.col("n_convs") - 1) * F.col("points")}).drop("alone"), "trie-nodes")
    shared = (F.col("n_convs") > 1) | (F.col("depth") == 0)
    summed = nodes.filter(~shared).unionByName(_totals(nodes.filter(shared), rows, shared_top, crowd, queue))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("u1"), F.col("p2").alias("u2"),
                           F.col("conv_id").alias("parent_conv_id"))
    told = attach(summed, parents, ["depth", "u1", "u2"]).join(ends(rows), key, "left")
    return told.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("digest", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
