"""Find and remove word sequences that an earlier document has.

Method: De Bruijn compaction. Each window of ``WINDOW`` words is an edge between the
nodes of its first and its last ``WINDOW - 1`` words. Edges meet by hash, and each is
given the document where it starts first. Joined back to the documents, edges that
follow each other and lead to the same earlier document make one path: a repeated span
with its place here and its source.

Only edges that an earlier document has are joined back, packed by document; an edge is a
64-bit hash of its words. An edge that very many documents have is sent once a slice,
and its source to every bucket of documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.common import by_batch, in_slices
from tallygrid.llm.hashes import joined, lot_of, packed, split_by, window_hashes

WINDOW = 13
BYTES_A_LOT = 12_000_000
HOT_LEAST = 64  # documents of a slice that have an edge, and share of them, from which
HOT_SHARE = 1 / 64  # on it counts as hot there
_LAST = np.iinfo(np.int64).max  # stands for a null id: no document is smaller by it
_HOT = -1


def _prime_from(n: int) -> int:
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _ids(column) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)


def _edges_by_lot(window: int, lots: int, hot_least: int, hot_share: float):
    """Each slice's distinct edges by range, with their documents; of hot ones the first."""

    def make():
        def each(batch):
            for part in in_slices(batch, "text", 1 << 24):
                own = [np.unique(window_hashes(t.split(), window)) if t else np.zeros(0, np.uint64)
                       for t in part["text"].to_pylist()]
                edges = np.concatenate(own)
                if not len(edges):
                    continue
                docs = np.repeat(_ids(part["doc_id"]), [len(x) for x in own])
                order = np.lexsort((docs, edges))
                edges, docs = edges[order], docs[order]
                begins = np.flatnonzero(np.r_[True, edges[1:] != edges[:-1]])
                often = np.diff(np.r_[begins, len(edges)])
                hot = often >= max(hot_least, hot_share * len(own))
                lone = np.repeat(~hot, often)
                hot_edges, hot_docs = edges[begins[hot]], docs[begins[hot]]
                edges, docs = edges[lone], docs[lone]
                order = np.argsort(docs, kind="stable")
                edges, docs = edges[order], docs[order]
                hot_lots = dict(split_by(lot_of(hot_edges, lots)))
                lot_parts = dict(split_by(lot_of(edges, lots)))
                rows = []
                for lot in sorted({*lot_parts, *hot_lots}):
                    at = lot_parts.get(lot, np.zeros(0, dtype=np.int64))
                    there, counts = np.unique(docs[at], return_counts=True)
                    h = hot_lots.get(lot, np.zeros(0, dtype=np.int64))
                    rows.append((lot, packed(there, "<i8"), packed(counts, "<u4"), packed(edges[at], "<u8"),
                                 packed(hot_edges[h], "<u8"), packed(hot_docs[h], "<i8")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if i == 0 else pa.binary())
                     for i, c in enumerate(zip(*rows, strict=True))],
                    names=["lot", "docs", "counts", "edges", "hot_edges", "hot_docs"])

        return each

    return by_batch(make)


def _sources(buckets: int):
    """The edges of a range that an earlier document has, with the first one, dealt out by
    document; hot edges go to every bucket."""

    def run(key, table):
        hot = joined(table["hot_edges"], "<u8")
        n_hot = len(hot)
        edges = np.concatenate([hot, joined(table["edges"], "<u8")])
        docs = np.concatenate([joined(table["hot_docs"], "<i8"),
                               np.repeat(joined(table["docs"], "<i8"), joined(table["counts"], "<u4"))])
        is_hot = np.arange(len(edges)) < n_hot
        order = np.lexsort((docs, edges))
        edges, docs, is_hot = edges[order], docs[order], is_hot[order]
        begins = np.flatnonzero(np.r_[True, edges[1:] != edges[:-1]])
        often = np.diff(np.r_[begins, len(edges)])
        first = np.repeat(docs[begins], often)
        any_hot = np.repeat(np.logical_or.reduceat(is_hot, begins), often)
        spread = np.flatnonzero(any_hot & np.r_[True, edges[1:] != edges[:-1]])
        later = np.flatnonzero((docs > first) & ~any_hot)
        rows = []
        if len(spread):
            whole = (packed(np.array([_HOT]), "<i8"), packed(np.array([len(spread)]), "<u4"),
                     packed(edges[spread], "<u8"), packed(first[spread], "<i8"))
            rows += [(b, *whole) for b in range(buckets)]
        for bucket, at in split_by(np.mod(docs[later], buckets).astype(np.int32)):
            at = later[at]
            at = at[np.argsort(docs[at], kind="stable")]
            there, counts = np.unique(docs[at], return_counts=True)
            rows.append((bucket, packed(there, "<i8"), packed(counts, "<u4"), packed(edges[at], "<u8"),
                         packed(first[at], "<i8")))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.table([pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(columns)],
                        names=["bucket", "docs", "counts", "edges", "first"])

    return run


def _paths(words: list[bytes], doc: int, window: int, edges: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, words, source) of each path, from the sorted edges known to be repeated."""
    own = window_hashes(words, window)
    if not len(own) or not len(edges):
        return []
    at = np.minimum(np.searchsorted(edges, own), len(edges) - 1)
    source = np.where(edges[at] == own, first[at], _LAST)
    on = np.flatnonzero(source < doc)
    if not len(on):
        return []
    breaks = np.flatnonzero((np.diff(on) != 1) | (np.diff(source[on]) != 0)) + 1
    return [(int(run[0]), len(run) + window - 1, int(source[run[0]])) for run in np.split(on, breaks)]


def _by_document(window: int, result, names: list[str], kinds: list[pa.DataType]):
    """Apply ``result`` (doc_id, words, paths) to each document of a bucket."""

    def run(key, texts, known):
        parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for docs, counts, edges, first in zip(*(known[c].to_pylist() for c in ("docs", "counts", "edges", "first")),
                                              strict=True):
            edges, first, at = np.frombuffer(edges, "<u8"), np.frombuffer(first, "<i8"), 0
            for doc, n in zip(np.frombuffer(docs, "<i8").tolist(), np.frombuffer(counts, "<u4").tolist(), strict=True):
                parts.setdefault(doc, []).append((edges[at : at + n], first[at : at + n]))
                at += n
        hot = parts.pop(_HOT, [])
        empty = (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
        rows = []
        for doc_id, doc, text in zip(texts["doc_id"].to_pylist(), _ids(texts["doc_id"].combine_chunks()).tolist(),
                                     texts["text"].to_pylist(), strict=True):
            words = text.split() if text else []
            own = [*parts.get(doc, []), *hot]
            edges, first = (np.concatenate(x) for x in zip(*own, strict=True)) if own else empty
            order = np.argsort(edges, kind="stable")
            rows += result(doc_id, words, _paths(words, doc, window, edges[order], first[order]))
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        kind = [texts.schema.field("doc_id").type, *kinds]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kind, strict=True)], names=names)

    return run


def _apply(docs: DataFrame, window: int, result, shape: str, kinds: list[pa.DataType]) -> DataFrame:
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    lots = _prime_from(max(7, -(-size // BYTES_A_LOT)))
    blobs = texts.mapInArrow(
        _edges_by_lot(window, lots, HOT_LEAST, HOT_SHARE),
        "lot int, docs binary, counts binary, edges binary, hot_edges binary, hot_docs binary")
    sources = blobs.groupBy("lot").applyInArrow(
        _sources(lots), "bucket int, docs binary, counts binary, edges binary, first binary")
    # The remainder by a prime, as in numpy; the place of a null id is that of _LAST.
    bucket = F.pmod(F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_LAST))), F.lit(lots)).cast("int")
    texts = texts.withColumn("bucket", bucket)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *(c.split()[0] for c in shape.split(", "))]
    return texts.groupBy("bucket").cogroup(sources.groupBy("bucket")).applyInArrow(
        _by_document(window, result, names, kinds), f"doc_id {kind}, {shape}")


def _covered(words: list[bytes], paths: list[tuple[int, int, int]]) -> np.ndarray:
    removed = np.zeros(len(words), dtype=bool)
    for start, n, _ in paths:
        removed[start : start + n] = True
    return removed


def _digest(doc_id, words, paths):
    removed = _covered(words, paths)
    kept = [w for w, gone in zip(words, removed.tolist(), strict=True) if not gone] if paths else words
    yield doc_id, len(words), int(removed.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()


def _kept_text(doc_id, words, paths):
    removed = _covered(words, paths).tolist()
    yield doc_id, b" ".join(w for w, gone in zip(words, removed, strict=True) if not gone).decode()


def _spans(doc_id, words, paths):
    return [(doc_id, *path) for path in paths]


def repeated_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the words left, joined by one space)
    for every row of ``docs``.

    A word is removed if a window of the input that covers it also starts in a document
    with a smaller id. Null text has no words; a null id is larger than any other, and
    equal to itself; rows with one id remove nothing from each other. Texts shorter than
    the window keep all words. An empty table gives an empty result. Ids are integers.
    """
    return _apply(docs, window, _digest, "n_words long, n_removed long, kept_sha256 string",
                  [pa.int64(), pa.int64(), pa.string()])


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The paths: doc_id, start (words before it), n_words and source, an earlier document
    that has all the span's windows first. Spans may overlap where sources change."""
    return _apply(docs, window, _spans, "start long, n_words long, source long", [pa.int64()] * 3)


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id and the text that is left, its words joined by one space."""
    return _apply(docs, window, _kept_text, "text string", [pa.string()])
