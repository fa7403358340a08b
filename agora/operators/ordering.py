"""Positions and running totals over a global order, without a one-partition window.

Rows are range-partitioned and sorted, numbered inside their partition, and
written once. A summary with one row for each partition then turns local
numbers into global ones.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.session import materialize

_SLOT, _TIE, _PART = "_slot", "_tie", "_part"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


@dataclass(frozen=True)
class Indexed:
    frame: DataFrame
    totals: dict[tuple, int]  # rows in each group of ``within``; the key is () without groups

    @property
    def total(self) -> int:
        return sum(self.totals.values())


def _laid_out(
    df: DataFrame,
    order: Sequence[str],
    spread_ties: bool,
    partitions: int | None,
    merge: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    keys = list(order)
    if spread_ties:
        # Equal rows may trade places, so they may also be spread over partitions.
        df = df.withColumn(_TIE, F.monotonically_increasing_id())
        keys.append(_TIE)
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    if merge:
        ranged = merge(ranged)
    ordered = ranged.sortWithinPartitions(*keys).drop(_TIE)
    slot = F.monotonically_increasing_id()
    placed = ordered.withColumn(_SLOT, slot).withColumn(_PART, F.shiftright(_SLOT, _ROW_BITS).cast("int"))
    return materialize(placed, "ordered")


def index_rows(
    df: DataFrame,
    order_by: Sequence[str],
    within: Sequence[str] = (),
    name: str = "idx",
    spread_ties: bool = False,
    partitions: int | None = None,
    merge: Callable[[DataFrame], DataFrame] | None = None,
) -> Indexed:
    """Dense 0-based position by ``order_by``, restarting in every group of ``within``.

    ``order_by`` must be a total order up to equal rows; set ``spread_ties`` when
    many rows may be equal in it. ``merge`` may group rows by the whole order
    where they lie, which takes no shuffle of its own; the merged rows are
    numbered. Groups are few (types or classes): the summary
    held by the driver has one row for each partition and group boundary.
    """
    within = list(within)
    stored = _laid_out(df, [*within, *order_by], spread_ties, partitions, merge)
    columns = [c for c in stored.columns if c not in (_SLOT, _PART)]
    runs = (
        stored.groupBy(_PART, *within)
        .agg(F.count(F.lit(1)).alias("rows"), F.min(_SLOT).alias("start"))
        .collect()
    )
    totals: dict[tuple, int] = {}
    offsets = []
    for run in sorted(runs, key=lambda r: r[_PART]):
        group = tuple(run[c] for c in within)
        offsets.append((run[_PART], *group, totals.get(group, 0) - run["start"]))
        totals[group] = totals.get(group, 0) + run["rows"]
    schema = f"{_PART} int" + "".join(f", {c} {stored.schema[c].dataType.simpleString()}" for c in within)
    shift = df.sparkSession.createDataFrame(offsets, f"{schema}, _shift bigint")
    # Bounded: one row for each range partition plus one for each further group.
    joined = stored.join(F.broadcast(shift), [_PART, *within])
    frame = joined.withColumn(name, F.col(_SLOT) + F.col("_shift")).select(*columns, name)
    return Indexed(frame, totals)


def dense_index(df: DataFrame, order_by: Sequence[str], **options) -> DataFrame:
    return index_rows(df, order_by, **options).frame


def running_totals(
    df: DataFrame,
    order_by: Sequence[str],
    sums: dict[str, str],
    next_of: dict[str, str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add inclusive running sums of columns over a unique global order.

    ``sums`` maps new names to summed columns. ``next_of`` maps new names to
    columns whose value in the following row is wanted (NULL in the last row).
    """
    next_of = next_of or {}
    stored = _laid_out(df, order_by, False, partitions)
    parts = (
        stored.groupBy(_PART)
        .agg(
            *[F.sum(source).alias(f"_sum_{name}") for name, source in sums.items()],
            *[F.min_by(source, _SLOT).alias(f"_first_{name}") for name, source in next_of.items()],
        )
        .orderBy(_PART)
        .collect()
    )
    carried = {name: 0 for name in sums}
    edges = []
    for here, after in zip(parts, [*parts[1:], None]):
        heads = [None if after is None else after[f"_first_{name}"] for name in next_of]
        edges.append((here[_PART], *carried.values(), *heads))
        carried = {name: carried[name] + here[f"_sum_{name}"] for name in sums}
    schema = [f"{_PART} int", *[f"_base_{n} bigint" for n in sums]]
    schema += [f"_head_{n} {stored.schema[s].dataType.simpleString()}" for n, s in next_of.items()]
    edge_frame = df.sparkSession.createDataFrame(edges, ", ".join(schema))
    local = Window.partitionBy(_PART).orderBy(_SLOT)
    frame = stored
    for name, source in sums.items():
        frame = frame.withColumn(name, F.sum(source).over(local.rowsBetween(Window.unboundedPreceding, 0)))
    for name, source in next_of.items():
        frame = frame.withColumn(name, F.lead(source).over(local))
    # Bounded: one row for each range partition.
    frame = frame.join(F.broadcast(edge_frame), _PART)
    results: list[Column] = [F.col(c) for c in df.columns]
    results += [(F.col(n) + F.col(f"_base_{n}")).alias(n) for n in sums]
    results += [F.coalesce(n, f"_head_{n}").alias(n) for n in next_of]
    return frame.select(*results)
