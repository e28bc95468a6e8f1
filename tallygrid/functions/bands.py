"""Table-driven banding and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallygrid.functions.money import column


def below_bands(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``labels[i]`` for values below ``edges[i]``, the last label beyond them.

    A null value stays null instead of falling into the last band.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need exactly one label more than edges")
    c = column(c)
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        out = out.when(c < edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def points_at_least(c: Column | str, steps: Sequence[float]) -> Column:
    """Points for a value that should be high: best step first, 1 for the rest."""
    out = None
    for points, step in zip(range(len(steps) + 1, 1, -1), steps):
        out = (F if out is None else out).when(column(c) >= step, F.lit(points))
    return out.otherwise(F.lit(1))


def points_at_most(c: Column | str, steps: Sequence[float]) -> Column:
    """Points for a value that should be low: best step first, 1 for the rest."""
    out = None
    for points, step in zip(range(len(steps) + 1, 1, -1), steps):
        out = (F if out is None else out).when(column(c) <= step, F.lit(points))
    return out.otherwise(F.lit(1))


def first_reached(c: Column | str, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first cut (in falling order) that the value reaches."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("need exactly one label more than cuts")
    out = None
    for cut, label in zip(cuts, labels):
        out = (F if out is None else out).when(column(c) >= cut, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))
