"""Exact quantile of a column, in passes that keep bounded state."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000


def exact_quantile(df: DataFrame, column: str, q: float, max_values: int = 50_000) -> float | None:
    """Linear-interpolated quantile over the non-missing values of ``column``.

    A quantile sketch brackets the wanted ranks, then the distinct values inside
    the bracket are counted. While the bracket holds more than ``max_values``
    distinct values a sketch of the bracket narrows it further, so neither a
    task nor the driver holds more than that many, whatever the size of ``df``.
    Counting per value first keeps repeated values cheap.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    bracket, total, below, inside = values, None, 0, None
    margin = 2 / ACCURACY
    while True:
        if total is None:
            shares = [max(q - margin, 0.0), min(q + margin, 1.0)]
        else:
            shares = _shares(first, last, below, inside, margin)
        sketch = bracket.agg(F.count("v").alias("n"), F.percentile_approx("v", shares, ACCURACY).alias("p")).first()
        if sketch["n"] == 0:
            return None
        if total is None:
            total = inside = sketch["n"]
            position = q * (total - 1)
            first, last = math.floor(position), math.ceil(position)
        low, high = sketch["p"]
        before, counts = _bracket_counts(values, low, high, max_values)
        narrowed = values.where(F.col("v").between(low, high))
        held = sum(n for _, n in counts) if len(counts) <= max_values else narrowed.count()
        if not before <= first <= last < before + held:
            margin *= 8  # the sketch missed a rank; a wider one reaches the whole bracket in the end
        elif len(counts) <= max_values:
            lower, upper = (_value_at(counts, before, rank) for rank in (first, last))
            return lower if lower == upper else lower + (upper - lower) * (position - first)
        else:
            bracket, below, inside = narrowed, before, held


def _shares(first: int, last: int, below: int, inside: int, margin: float) -> list[float]:
    span = max(inside - 1, 1)
    return [max((first - below) / span - margin, 0.0), min((last - below) / span + margin, 1.0)]


def _bracket_counts(values: DataFrame, low: float, high: float, max_values: int):
    """Rows below the bracket and, in order, (value, rows) for at most ``max_values + 1`` values in it."""
    keyed = values.where(F.col("v") <= high).select(F.when(F.col("v") >= low, F.col("v")).alias("v"))
    rows = keyed.groupBy("v").count().orderBy(F.col("v").asc_nulls_first()).limit(max_values + 2).collect()
    below = sum(r["count"] for r in rows if r["v"] is None)
    return below, [(r["v"], r["count"]) for r in rows if r["v"] is not None][: max_values + 1]


def _value_at(counts: list[tuple[float, int]], before: int, rank: int) -> float:
    seen = before
    for value, n in counts:
        seen += n
        if rank < seen:
            return value
    raise ValueError("rank lies outside the bracket")
