"""Whiten embeddings: centred, turned to their principal components, each of variance one.

Method: polarisation. For every dimension, and for the sum of every two dimensions, the
squared centred values are summed, exactly. As Var(a + b) = Var(a) + Var(b) + 2 Cov(a, b),
differences of those variances are all covariances; the matrix goes to an eigensolver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.common import by_batch

COMPONENTS = 8
SCALE = 1024
SHIFT = 100_000
DIGIT = 30  # bits of the digits in which whole numbers of any size are summed
ROWS = 1 << 14  # rows whose sums are made at once
SMALL = 1 << 22  # below it, ROWS squares of sums of two values fit a 64-bit integer

Numbers = dict[tuple[int, int], int]


def _usable(vector: Column) -> Column:
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, finite)


def vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """The column ``v`` (doubles) of the rows whose vector is whole: no null, no entry
    null or not finite, and of the commonest length (of two as common, the longer)."""
    named = df.select(F.col("vec_id"), F.col(vector).cast("array<double>").alias("v")).filter(_usable(F.col("v")))
    lengths = named.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n"))
    best = lengths.agg(F.max(F.struct("n", "length"))["length"].alias("length"))
    size = best.first()["length"]
    return named.filter(F.size("v") == F.lit(-1 if size is None else size))


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """floor(1024 c) + 100000 of doubles; Python integers where 64 bits may not do."""
    if np.abs(values).max(initial=0.0) < 2.0**40:
        return np.floor(values * SCALE).astype(np.int64) + SHIFT
    scaled = [int(c) * SCALE if abs(c) >= 2.0**40 else int(np.floor(c * SCALE)) for c in values.ravel().tolist()]
    return (np.array(scaled, dtype=object) + SHIFT).reshape(values.shape)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch["v"].flatten().to_numpy(zero_copy_only=False)
    return whole_numbers(flat.reshape(batch.num_rows, -1))


def _less(x: np.ndarray, low: list[int]) -> np.ndarray:
    return x - np.array(low, dtype=x.dtype if max(map(abs, low)) < 2**61 else object)


def _digits(totals: dict[tuple[int, int], int]) -> Iterator[pa.RecordBatch]:
    """Whole numbers as rows (i, j, digit, part), which Spark can add up without overflow."""
    rows = []
    for (i, j), total in totals.items():
        sign, rest, digit = (-1, -total, 0) if total < 0 else (1, total, 0)
        while rest:
            rows.append((i, j, digit, sign * (rest & ((1 << DIGIT) - 1))))
            rest, digit = rest >> DIGIT, digit + 1
    for at in range(0, len(rows), 100_000):
        i, j, digit, part = zip(*rows[at : at + 100_000], strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(digit, pa.int32()), pa.array(part, pa.int64())],
            names=["i", "j", "digit", "part"])


def _summed(rows: DataFrame, sums: Callable[[np.ndarray], Iterator[tuple[int, np.ndarray]]]) -> Numbers:
    """Exact sums over all rows. ``sums`` gives, for a matrix of whole numbers, pairs of
    i and the sums of (i, i), (i, i + 1) ... Each task hands over one number for each pair."""

    def run(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                for i, found in sums(_matrix(batch.slice(at, ROWS))):
                    found = found.astype(object)
                    totals[i] = totals[i] + found if i in totals else found
        yield from _digits({(i, i + k): int(x) for i, found in totals.items() for k, x in enumerate(found)})

    parts = rows.select("v").mapInArrow(run, "i int, j int, digit int, part long")
    out: Numbers = {}
    for r in parts.groupBy("i", "j", "digit").agg(F.sum("part").alias("part")).collect():
        out[r["i"], r["j"]] = out.get((r["i"], r["j"]), 0) + (r["part"] << (DIGIT * r["digit"]))
    return out


def _squares(low: list[int]) -> Callable[[np.ndarray], Iterator[tuple[int, np.ndarray]]]:
    """Sums of the squares of y and of sums of two y, where y is x less ``low``."""

    def sums(x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        y = _less(x, low)
        if y.dtype != object and np.abs(y).max(initial=0) >= SMALL:
            y = y.astype(object)
        for i in range(y.shape[1]):
            both = y[:, i : i + 1] + y[:, i:]
            both[:, 0] = y[:, i]
            yield i, (both * both).sum(axis=0)

    return sums


@dataclass
class Whitening:
    """``vectors``: a column for each component. x - S/n is x - low - rest/n. ``unit`` is 1,
    or a power of two that variances are taken in where a double could not hold them."""

    n: int
    unit: int
    low: list[int]
    rest: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        near = _less(x, self.low)
        near = near.astype(float) if self.unit == 1 else (near.astype(object) / self.unit).astype(float)
        return near - np.array([r / (self.n * self.unit) for r in self.rest])

    def of(self, x: np.ndarray) -> np.ndarray:
        """Whitened components of rows; not a number where a component has no variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, self.centred(x) @ self.vectors / np.sqrt(self.values), np.nan)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 of each row; None where it does not fit a long."""
        near = _less(x, self.low)
        most = int(np.abs(near).max(initial=0)) + 1
        kind = np.int64 if (self.n * most) ** 2 * max(1, x.shape[1]) < 2**62 else object
        off = near.astype(kind) * self.n - np.array(self.rest, dtype=kind)
        return [int(s) if s < 2**63 else None for s in (off * off).sum(axis=1).tolist()]


def _unit(squares: Numbers) -> int:
    bits = max((x.bit_length() for x in squares.values()), default=0)
    return 1 if bits < 900 else 1 << (bits - 800) // 2


def covariances(n: int, rest: list[int], squares: Numbers, unit: int = 1) -> np.ndarray:
    """From the sums of squares of x - low, and of its sums of two dimensions; in unit^2.

    The sum of (n u - S)^2 is n^2 times the sum of (u - low)^2, less n rest^2; it is taken
    for u of one dimension and of two, in whole numbers, and divided once.
    """
    size = len(rest)

    def spread(i: int, j: int) -> int:
        r = rest[i] if i == j else rest[i] + rest[j]
        return n * n * squares.get((i, j), 0) - n * r * r

    alone = [spread(i, i) for i in range(size)]
    found = np.zeros((size, size))
    for i in range(size):
        found[i, i] = alone[i] / (n**3 * unit**2)
        for j in range(i + 1, size):
            found[i, j] = found[j, i] = (spread(i, j) - alone[i] - alone[j]) / (2 * n**3 * unit**2)
    return found


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learn from all of ``rows`` (as ``vectors`` gives them); None if there are none or
    they have no entry. The driver gets one number for each pair of dimensions."""
    n = rows.count()
    sums = _summed(rows, lambda x: iter([(0, np.concatenate([[len(x)], x.sum(axis=0)]))])) if n else {}
    size = len(rows.select("v").first()["v"]) if n else 0
    if not size:
        return None
    totals = [sums.get((0, 1 + i), 0) for i in range(size)]
    low = [t // n for t in totals]
    rest = [t - n * m for t, m in zip(totals, low, strict=True)]
    squares = _summed(rows, _squares(low))
    unit = _unit(squares)
    matrix = covariances(n, rest, squares, unit)
    values, turned = np.linalg.eigh(matrix)
    values, turned = values[::-1][:components], turned[:, ::-1][:, :components]
    # Either sign would do; the largest entry is made positive, so that reruns agree.
    signs = np.sign(turned[np.abs(turned).argmax(axis=0), np.arange(turned.shape[1])])
    trace = float(np.trace(matrix))
    flat = values <= size * np.finfo(float).eps * max(trace, 0.0)
    return Whitening(n, unit, low, rest, matrix, np.where(flat, 0.0, values), turned * np.where(signs < 0, -1, 1),
                     values / trace if trace > 0 else np.full(len(values), np.nan))


def identity_error(rows: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the covariance of the whitened rows, less the identity,
    over the components that have variance; by polarisation as above, in doubles."""
    live = [k for k, v in enumerate(model.values) if v > 0]

    def run(batches):
        totals = np.zeros((len(live), len(live))), np.zeros(len(live))
        for batch in batches:
            w = model.of(_matrix(batch))[:, live]
            for i in range(len(live)):
                both = w[:, i : i + 1] + w
                both[:, i] = w[:, i]
                totals[0][i] += (both * both).sum(axis=0)
            totals[1][:] += w.sum(axis=0)
        for i in range(len(live)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * (len(live) + 1), pa.int32()), pa.array(range(len(live) + 1), pa.int32()),
                 pa.array([*totals[0][i], totals[1][i]], pa.float64())], names=["i", "j", "part"])

    if not live:
        return None
    parts = rows.select("v").mapInArrow(run, "i int, j int, part double")
    found = np.zeros((len(live), len(live) + 1))
    for r in parts.groupBy("i", "j").agg(F.sum("part").alias("part")).collect():
        found[r["i"], r["j"]] = r["part"]
    squares, mean = found[:, :-1] / model.n, found[:, -1] / model.n
    alone = np.diag(squares)
    cross = (squares - alone[:, None] - alone[None, :]) / 2
    np.fill_diagonal(cross, alone)
    return float(np.abs(cross - np.outer(mean, mean) - np.eye(len(live))).max())


def whitened(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error: a row for
    each row with a whole vector (see ``vectors``) and each of its first ``components``
    principal components, the strongest first.

    An entry c counts as x = floor(1024 c) + 100000. ``n`` rows have sums S of x; their
    covariances have divisor n. ``deviation`` is the sum over dimensions of (n x - S)^2,
    null where it does not fit a long. ``whitened`` is null for a component without
    variance, as with one row or equal rows, and so are the shares ``explained`` if no
    component has any. Null ids stay null, repeated rows are rows of their own, and a table
    without a whole vector gives no row. Entries of any finite size are summed exactly.

    Each task sends one number for every two dimensions; only those reach the driver, and
    the square matrix of the dimensions is all that it solves.
    """
    kind = df.schema["vec_id"].dataType.simpleString()
    shape = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
             "identity_error double")
    rows = vectors(df, vector)
    model = fit(rows, components)
    if model is None:
        return df.sparkSession.createDataFrame([], shape)
    error = identity_error(rows, model)
    count = len(model.values)

    def make():
        def each(batch):
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = _matrix(part)
                rows_of = np.repeat(np.arange(len(x)), count)
                explained = np.tile(model.explained, len(x))
                found = model.of(x).ravel()
                yield pa.RecordBatch.from_arrays(
                    [part["vec_id"].take(pa.array(rows_of)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                     pa.array([model.n] * len(rows_of), pa.int64()),
                     pa.array(model.deviations(x), pa.int64()).take(pa.array(rows_of)),
                     pa.array(found, mask=np.isnan(found)), pa.array(explained, mask=np.isnan(explained)),
                     pa.array([error] * len(rows_of), pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

        return each

    return rows.mapInArrow(by_batch(make), shape)
