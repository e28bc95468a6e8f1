"""Pack documents into sequences of a fixed number of tokens.

Method: space-filling-curve order. Each document's hashed token vector is projected to
three dimensions, documents are range-sorted by their place on a Hilbert curve through
them, and neighbours along the curve share sequences.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm import hashes
from tallygrid.llm.common import by_batch, in_slices, stored
from tallygrid.llm.tokens import IDS, VOCABULARY, public_path, tokens

LENGTH = 4096
END = 2
HASHED = 64  # dimensions of the hashed vector
AXES = 3
BITS = 16


def _axes(size: int, seed: int = 7) -> np.ndarray:
    """For each token id, what it adds on each axis: its random signs in the hashed
    dimensions, projected at random."""
    draw = np.random.default_rng(seed)
    signs = draw.choice(np.array([-1, 1], dtype=np.float32), size=(size, HASHED))
    return (signs @ draw.standard_normal((HASHED, AXES)).astype(np.float32)) / np.sqrt(HASHED)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of points with whole coordinates below 2 ** bits, one
    row a point (the Gray code method of Skilling, 2004)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(n):
            up = (x[i] & bit) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(up, x[0] ^ below, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where((x[-1] >> level) & 1, turn ^ ((1 << level) - 1), turn)
    x ^= turn
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((x[i] >> level) & 1)
    return place


def _encoded(path: str):
    def make():
        hashes.forget()
        known = tokens(path)
        axes = _axes(1 << 16)
        end = np.array([END], dtype=IDS).tobytes()

        def each(batch):
            for part in in_slices(batch, "text", 1 << 23):
                ids = [known.of(t) + end for t in part["text"].to_pylist()]
                points = np.array([axes[np.frombuffer(x, IDS)].mean(axis=0) for x in ids])
                cells = np.clip((0.5 + np.arctan(4 * points) / np.pi) * (1 << BITS), 0, (1 << BITS) - 1)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(hilbert(cells.astype(np.int64))),
                     pa.array([len(x) // IDS.itemsize for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "place", "n", "ids"])

        return each

    return by_batch(make)


def _numbered(batches):
    """Add where each document starts among the tokens of its task's rows."""
    at = 0
    for batch in batches:
        n = batch["n"].to_numpy()
        if len(n):
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            yield batch.append_column("start", pa.array(starts, pa.int64()))


def _edges(total: int, length: int) -> tuple[int, list[tuple[int, int]]]:
    """Where the last full sequence ends, and (start, length) of the shorter ones after
    it: the tokens left over are cut at powers of two, which need no padding."""
    full = total - total % length
    at, rest = full, []
    for power in range(length.bit_length(), -1, -1):
        if (total - full) >> power & 1:
            rest.append((at, 1 << power))
            at += 1 << power
    return full, rest


def _cut(bases: dict[int, int], total: int, length: int):
    def make():
        full, rest = _edges(total, length)

        def sequence(at: int) -> tuple[int, int, int]:
            """Number, start and end of the sequence that holds token ``at``."""
            if at < full:
                return at // length, at - at % length, at - at % length + length
            for i, (start, size) in enumerate(rest):
                if at < start + size:
                    return full // length + i, start, start + size
            raise ValueError(at)

        def each(batch):
            for part in in_slices(batch, "ids", 1 << 23):
                rows = []
                for doc, lot, start, ids in zip(*(part[c].to_pylist() for c in ("doc_id", "lot", "start", "ids")),
                                                strict=True):
                    ids = np.frombuffer(ids, IDS).astype("<u4")
                    base, done = bases[lot] + start, 0
                    while done < len(ids):
                        number, begin, end = sequence(base + done)
                        piece = ids[done : done + end - (base + done)]
                        rows.append((doc, done, len(piece), zlib.crc32(piece.tobytes()), len(ids), number,
                                     base + done - begin))
                        done += len(piece)
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, part.schema.field("doc_id").type if i == 0 else pa.int64())
                     for i, c in enumerate(columns)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        return each

    return by_batch(make)


def pack(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None) -> DataFrame:
    """The pieces of documents that fill sequences of ``length`` tokens, one row a piece:
    doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset.

    A document is the ids of its text and then ``END``; null text is empty text, and
    gives that one id. Documents stand end to end in curve order, equal places by id,
    and are cut where a sequence ends. Only the last few sequences are shorter, each of a
    power of two, so that nothing is padded. Null ids are ids, and repeated rows are rows
    of their own; an empty table gives no piece. ``vocabulary`` is a path that every
    executor has.

    Ids travel through one shuffle, two bytes each. The driver gets one token count for
    each task of the sort.
    """
    path = vocabulary or public_path(VOCABULARY)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    shape = f"doc_id {kind}, place long, n long, ids binary"
    encoded = stored(texts.mapInArrow(_encoded(path), shape), "pack-ids")
    in_order = encoded.repartitionByRange("place", "doc_id").sortWithinPartitions("place", "doc_id", "n")
    placed = stored(
        in_order.withColumn("lot", F.spark_partition_id())
        .mapInArrow(_numbered, f"{shape}, lot int, start long")
        .drop("place"),
        "pack-order")
    bases, total = {}, 0
    for r in placed.groupBy("lot").agg(F.sum("n").alias("n")).orderBy("lot").collect():
        bases[r["lot"]] = total
        total += r["n"]
    return placed.mapInArrow(
        _cut(bases, total, length),
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
