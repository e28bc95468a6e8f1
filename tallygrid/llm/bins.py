"""Pack whole documents into as few sequences of a fixed number of tokens as can be.

Method: a grouping genetic algorithm. An individual is a partition of the documents into
sequences. Crossover injects whole well-filled sequences of one parent into the other,
removes what then stands twice, and best-fits the displaced documents. Documents are dealt
into blocks; each block has islands that evolve apart, and after each round the best
individual of an island moves to the next one. What a block leaves in ill-filled sequences
is dealt out again with what the other blocks leave.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.byte_tokens import IDS, byte_tokens
from tallygrid.llm.common import by_batch, in_slices, stored

LENGTH = 2048
END = 0
BLOCK = 2048  # documents that are packed together, on average
WELL_FILLED = 0.995
EMPTIED = 0.3  # of the ill-filled bins of a child
LEVELS = 6
ISLANDS = 16  # that one task evolves
ROW_BITS = 39  # of a piece's number, for the pieces of one task


@dataclass(frozen=True)
class Evolution:
    islands: int = 3
    rounds: int = 2
    individuals: int = 4
    children: int = 12  # of an island in a round


def best_fit(sizes: list[int], items: list[int], bins: list[list[int]], free: list[int], length: int) -> None:
    """Put each of ``items``, in their order, where the least room is left; a new bin if
    it fits nowhere. ``bins`` and ``free`` are added to."""
    scale = len(bins) + len(items) + 1
    room = sorted(f * scale + b for b, f in enumerate(free) if f)
    for item in items:
        at = bisect_left(room, sizes[item] * scale)
        if at < len(room):
            left, b = divmod(room.pop(at), scale)
            bins[b].append(item)
        else:
            left, b = length, len(bins)
            bins.append([item])
            free.append(length)
        free[b] = left = left - sizes[item]
        if left:
            insort(room, left * scale + b)


def least_bins(sizes: list[int], length: int) -> int:
    """No packing has fewer bins: documents of over half a bin share none with each other,
    and what is left of their bins and of the tokens that fill it gives the rest."""
    best = -(-sum(sizes) // length)
    large = sorted(s for s in sizes if 2 * s > length)
    small = sorted(s for s in sizes if 2 * s <= length)
    for least in sorted({s for s in small})[:200] or [0]:
        alone = len(large) - bisect_left(large, length - least + 1)  # no small one of this size fits beside them
        others = large[: len(large) - alone]
        rest = sum(small[bisect_left(small, least):]) - (len(others) * length - sum(others))
        best = max(best, len(large) + max(0, -(-rest // length)))
    return best


class Island:
    """Individuals are lists of bins of positions in ``sizes``, the best one first."""

    def __init__(self, sizes: list[int], length: int, draw: random.Random):
        self.sizes, self.length, self.draw = sizes, length, draw
        self.falling = sorted(range(len(sizes)), key=lambda i: -sizes[i])
        self.place = {item: k for k, item in enumerate(self.falling)}
        self.enough = least_bins(sizes, length)

    def cost(self, bins: list[list[int]]) -> tuple[int, int]:
        """Number of bins; of as many, full bins beside empty ones are better."""
        return len(bins), -sum(sum(self.sizes[i] for i in b) ** 2 for b in bins)

    def founder(self, noise: int) -> list[list[int]]:
        """Best fit of the documents by falling size; with noise, by a size that is off by so much at most."""
        order = self.falling if not noise else sorted(
            self.falling, key=lambda i: -self.sizes[i] + self.draw.randrange(noise))
        bins: list[list[int]] = []
        best_fit(self.sizes, order, bins, [], self.length)
        return bins

    def child(self, one: list[list[int]], other: list[list[int]]) -> list[list[int]]:
        """``one`` with well-filled bins of ``other`` in place of the bins they clash with.
        Some of the other ill-filled bins are emptied too, as mutation."""
        fill = [sum(self.sizes[i] for i in b) for b in other]
        by_fill = sorted(range(len(other)), key=lambda b: (-fill[b], self.draw.random()))
        injected = [other[b] for b in by_fill[: max(1, len(other) // 2)] if self.draw.random() < 0.5]
        taken = {i for b in injected for i in b}
        bins, displaced = [list(b) for b in injected], []
        for b in one:
            if not taken.isdisjoint(b):
                displaced += [i for i in b if i not in taken]
            elif sum(self.sizes[i] for i in b) < WELL_FILLED * self.length and self.draw.random() < EMPTIED:
                displaced += b
            else:
                bins.append(list(b))
        free = [self.length - sum(self.sizes[i] for i in b) for b in bins]
        best_fit(self.sizes, sorted(displaced, key=self.place.__getitem__), bins, free, self.length)
        return bins

    def evolved(self, people: list[list[list[int]]], how: Evolution) -> list[list[list[int]]]:
        """The next generations. Ends early once no packing can have fewer bins."""
        if not people:
            people = [self.founder(0)]
            while len(people) < how.individuals and len(people[0]) > self.enough:
                people.append(self.founder(1 + self.length // (4 << len(people))))
        ranked = sorted(((self.cost(p), p) for p in people), key=lambda x: x[0])
        for _ in range(how.children if len(ranked) > 1 else 0):
            if ranked[0][0][0] <= self.enough:
                break
            one, other = self.draw.sample(ranked, 2)
            born = self.child(one[1], other[1])
            cost = self.cost(born)
            if cost not in {c for c, _ in ranked}:
                ranked = sorted([*ranked, (cost, born)], key=lambda x: x[0])[: how.individuals]
        return [p for _, p in ranked]


def _packed(bins: list[list[int]], n: int) -> bytes:
    """The bin of each document, four bytes each."""
    out = np.zeros(n, dtype="<u4")
    for b, items in enumerate(bins):
        out[items] = b
    return out.tobytes()


def _unpacked(raw: bytes) -> list[list[int]]:
    of = np.frombuffer(raw, dtype="<u4")
    order = np.argsort(of, kind="stable")
    return [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(of[order])) + 1)] if len(of) else []


def _evolve(length: int, how: Evolution, level: int, turn: int):
    def make():
        def each(batch):
            for row in batch.to_pylist():
                draw = random.Random(f"{level} {turn} {row['block']} {row['island']}")
                island = Island(row["sizes"], length, draw)
                people = [_unpacked(p) for p in [*(row["people"] or []), *([row["guest"]] if row["guest"] else [])]]
                people = island.evolved(people, how)[: how.individuals]
                n, squares = island.cost(people[0])
                row["people"], row["guest"] = [_packed(p, len(row["sizes"])) for p in people], None
                row["bins"], row["squares"] = n, squares
                yield pa.RecordBatch.from_pylist([row], schema=_ISLAND_SCHEMA)

        return each

    return by_batch(make)


_ISLAND = ("block long, island int, sizes array<int>, people array<binary>, guest binary, bins int, squares long")
_ISLAND_SCHEMA = pa.schema([
    ("block", pa.int64()), ("island", pa.int32()), ("sizes", pa.list_(pa.int32())), ("people", pa.list_(pa.binary())),
    ("guest", pa.binary()), ("bins", pa.int32()), ("squares", pa.int64())])


def _evolved(blocks: DataFrame, count: int, length: int, how: Evolution, level: int) -> DataFrame:
    """The best packing of each of ``count`` blocks: block and best."""
    tasks = -(-count * how.islands // ISLANDS)  # given as a number, as rows are small and work is not
    none = {"people": F.lit(None).cast("array<binary>"), "guest": F.lit(None).cast("binary"),
            "bins": F.lit(0), "squares": F.lit(0).cast("long")}
    names = [c.split(" ")[0] for c in _ISLAND.split(", ")]
    states = blocks.select("block", "sizes").withColumn(
        "island", F.explode(F.sequence(F.lit(0), F.lit(how.islands - 1)))).withColumns(none).select(names)
    for turn in range(how.rounds):
        if turn:
            elites = states.select("block", ((F.col("island") + 1) % how.islands).cast("int").alias("island"),
                                   F.element_at("people", 1).alias("guest"))
            states = states.drop("guest").join(elites, ["block", "island"]).select(names)
        states = stored(states.repartition(tasks, "block", "island").mapInArrow(
            _evolve(length, how, level, turn), _ISLAND), f"bins-{level}-{turn}")
    return states.groupBy("block").agg(
        F.min_by(F.element_at("people", 1), F.struct("bins", "squares", "island")).alias("best"))


def _places(length: int, level: int):
    """Rows (row, number, offset, fill) of each block's documents in its best packing."""

    def make():
        def each(batch):
            for block, rows, sizes, best in zip(*(batch[c].to_pylist() for c in ("block", "rows", "sizes", "best")),
                                                strict=True):
                out = []
                for b, items in enumerate(_unpacked(best)):
                    number = (((level << 53 | block << 16) + b) << 1) | 1
                    at, fill = 0, sum(sizes[i] for i in items)
                    for i in items:
                        out.append((rows[i], sizes[i], number, at, fill))
                        at += sizes[i]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out, strict=True)],
                    names=["row", "length", "number", "offset", "fill"])

        return each

    return by_batch(make)


def placed(items: DataFrame, length: int = LENGTH, block: int = BLOCK, how: Evolution = Evolution(),
           levels: int = LEVELS) -> DataFrame:
    """row, number (of its sequence) and offset for each of ``items`` (row: a unique long,
    length: from 1 to ``length``).

    Blocks hold about ``block`` items whatever the table's size. A level deals what the
    level before left in sequences filled less than ``WELL_FILLED``; the last level keeps
    all that it packs, and so does one that began with a single block.
    """
    out = []
    for level in range(levels):
        n = items.count()
        blocks = max(1, -(-n // block))
        dealt = stored(
            items.groupBy(F.pmod(F.xxhash64(F.lit(level), "row"), F.lit(blocks)).cast("long").alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct("length", "row")), asc=False).alias("items"))
            .select("block", F.col("items.length").cast("array<int>").alias("sizes"), F.col("items.row").alias("rows")),
            f"bins-blocks-{level}")
        best = _evolved(dealt, blocks, length, how, level)
        found = stored(dealt.join(best, "block").mapInArrow(
            _places(length, level), "row long, length long, number long, offset long, fill long"), f"bins-{level}")
        last = blocks == 1 or level == levels - 1
        stays = F.lit(True) if last else F.col("fill") >= WELL_FILLED * length
        out.append(found.filter(stays).select("row", "number", "offset"))
        if last:
            break
        items = found.filter(~stays).select("row", "length")
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def _cut(path: str | None, length: int, with_ids: bool):
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "row"] + ["ids"] * with_ids

    def make():
        known, task = byte_tokens(path), TaskContext.get().partitionId()
        made = 0

        def each(batch):
            nonlocal made
            for part in in_slices(batch, "text", 1 << 23):
                ids, begins = known.of(part["text"], END)
                wide = ids.astype("<u4")
                of, piece, starts, ends = [], [], [], []
                for i, (a, b) in enumerate(zip(begins.tolist(), begins[1:].tolist(), strict=False)):
                    first = (b - a - 1) % length + 1
                    for k, end in enumerate(range(a + first, b + 1, length)):
                        of.append(i)
                        piece.append(k)
                        starts.append(end - (length if k else first))
                        ends.append(end)
                crc = [zlib.crc32(wide[a:b]) for a, b in zip(starts, ends, strict=True)]
                rows = (task << ROW_BITS) + made + np.arange(len(of))
                made += len(of)
                columns = [
                    part["doc_id"].take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(np.array(starts, dtype=np.int64) - begins[of]),
                    pa.array(np.array(ends, dtype=np.int64) - np.array(starts, dtype=np.int64)),
                    pa.array(crc, pa.int64()), pa.array(rows, pa.int64())]
                if with_ids:
                    columns.append(pa.array([ids[a:b].astype(IDS).tobytes() for a, b in zip(starts, ends, strict=True)],
                                            pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

        return each

    return by_batch(make)


def pieces(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and row of every piece of every document,
    with its ids (two bytes each, little-endian) if asked for. Rows are told apart by ``row``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, row long" + ", ids binary" * with_ids
    return docs.select("doc_id", "text").mapInArrow(_cut(vocabulary, length, with_ids), shape)


def pack(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None, block: int = BLOCK,
         how: Evolution = Evolution(), with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids if asked for):
    a row for each piece of a document, and where it stands.

    A document is the ids of its text and then ``END``; null text is empty text, and is
    that one id. A document of more than ``length`` ids is cut into pieces of ``length``,
    of which the first may be shorter; pieces of ``length`` have sequences to themselves.
    All others are packed whole. Null ids are ids, repeated rows are rows of their own, and
    an empty table gives no row. ``vocabulary`` is a path that every executor has.

    A piece's sequence depends on its task and place there, not on its id, so no id or text
    can make a block large. Texts and ids do not move: only lengths are dealt out and the
    places joined back.
    """
    cut = stored(pieces(docs, length, vocabulary, with_ids), "bins-pieces")
    columns = [c for c in cut.columns if c not in ("row", "ids")]
    ids = ["ids"] * with_ids
    full = cut.filter(F.col("length") == length).select(
        *columns, F.shiftleft("row", 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *ids)
    parts = cut.filter(F.col("length") < length)
    where = placed(parts.select("row", "length"), length, block, how)
    packed = parts.join(where, "row").select(*columns, F.col("number").alias("sequence_id"), "offset", *ids)
    return full.unionByName(packed)
