"""Seeded samples and splits of exact size.

Rows are ordered by the md5 of seed and key. Finding the hash at a given rank
takes a histogram over hash prefixes, so a sample or split is afterwards a
plain comparison on each row: no sort and no shuffle of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.operators.ordering import index_rows

_DIGITS = 3
_MAX_BUCKET = 20_000


def seeded_hash(seed: int | str, *keys: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def hash_cuts(
    df: DataFrame, keys: Sequence[str], seed: int | str, ranks: Callable[[int], Sequence[int]]
) -> tuple[int, list[tuple[str | None, int]]]:
    """Row count and, for each rank r, the hash h of the row at that rank.

    The second number is how many rows with just that hash belong below the
    rank: 0 unless rows share a key. At a rank at or beyond the row count the
    hash is None: every row lies below it.
    """
    hashed = df.select(seeded_hash(seed, *keys).alias("h"))
    prefix = F.substring("h", 1, _DIGITS)
    histogram = {r["p"]: r["count"] for r in hashed.groupBy(prefix.alias("p")).count().collect()}
    total = sum(histogram.values())
    wanted = list(ranks(total))
    cuts: list[tuple[str | None, int]] = [(None, 0)] * len(wanted)
    pending = {}
    for place, rank in enumerate(wanted):
        if rank < total:
            pending[place] = _bucket_of(histogram, rank)
    while pending:
        digits = len(next(iter(pending.values()))[0])
        largest = max(size for _, _, size in pending.values())
        buckets = sorted({bucket for bucket, _, _ in pending.values()})
        inside = hashed.where(F.substring("h", 1, digits).isin(buckets))
        if largest > _MAX_BUCKET and digits < 32:
            finer = F.substring("h", 1, min(digits + _DIGITS, 32)).alias("p")
            counts = {r["p"]: r["count"] for r in inside.groupBy(finer).count().collect()}
            for place, (bucket, before, _) in pending.items():
                own = {p: n for p, n in counts.items() if p.startswith(bucket)}
                pending[place] = _bucket_of(own, wanted[place] - before, before)
            continue
        rows = inside.groupBy("h").count().collect()
        for place, (bucket, before, _) in pending.items():
            own = sorted((r["h"], r["count"]) for r in rows if r["h"].startswith(bucket))
            seen = before
            for value, n in own:
                if wanted[place] < seen + n:
                    cuts[place] = (value, wanted[place] - seen)
                    break
                seen += n
        pending = {}
    return total, cuts


def _bucket_of(histogram: dict[str, int], rank: int, before: int = 0) -> tuple[str, int, int]:
    seen = 0
    for bucket in sorted(histogram):
        if seen + histogram[bucket] > rank:
            return bucket, before + seen, histogram[bucket]
        seen += histogram[bucket]
    raise ValueError("rank lies outside the histogram")


def _below(hashed: Column, cut: str | None) -> Column:
    return F.lit(True) if cut is None else hashed < cut


def _unique_cuts(df: DataFrame, keys: Sequence[str], seed: int | str, ranks) -> list[str | None]:
    """Cuts of a split, which must not divide the rows of one key."""
    _, cuts = hash_cuts(df, keys, seed, ranks)
    if any(inside for _, inside in cuts):
        raise ValueError(f"keys {list(keys)} repeat at a cut")
    return [cut for cut, _ in cuts]


def sample_exact(df: DataFrame, n: int, key: str | Sequence[str], seed: int = 42) -> DataFrame:
    """Uniform sample of exactly ``n`` rows without replacement; fewer rows are an error.

    If the last place falls among rows that share a key, the first of them by
    all their columns are taken.
    """
    keys = [key] if isinstance(key, str) else list(key)
    total, [(cut, inside)] = hash_cuts(df, keys, seed, lambda _: [n])
    if total < n:
        raise ValueError(f"cannot sample {n} rows from {total}")
    hashed = seeded_hash(seed, *keys)
    sample = df.where(_below(hashed, cut))
    if inside:
        sample = sample.unionByName(take_first(df.where(hashed == cut), inside, df.columns))
    return sample


def take_first(
    df: DataFrame, n: int, order_by: Sequence[str], position: str | None = None
) -> DataFrame:
    """The first ``n`` rows by an explicit order; fewer rows are an error. Equal rows may be many."""
    name = position or "_position"
    indexed = index_rows(df, order_by, name=name, spread_ties=True)
    if indexed.total < n:
        raise ValueError(f"cannot take {n} rows from {indexed.total}")
    head = indexed.frame.where(F.col(name) < n)
    return head if position else head.drop(name)


def train_test_split(
    df: DataFrame, key: str | Sequence[str], test_share: float = 0.2, seed: int = 42, name: str = "split"
) -> DataFrame:
    """Label rows 'test' or 'train'; the test part has ``ceil(share * n)`` rows."""
    keys = [key] if isinstance(key, str) else list(key)
    (cut,) = _unique_cuts(df, keys, seed, lambda n: [math.ceil(test_share * n)])
    is_test = _below(seeded_hash(seed, *keys), cut)
    return df.withColumn(name, F.when(is_test, "test").otherwise("train"))


def node_split(
    nodes: DataFrame, target: str, val_share: float = 0.1, test_share: float = 0.1, seed: int = 42
) -> DataFrame:
    """Set ``split`` to val, test or train on the labelled node type, NULL elsewhere."""
    labelled = nodes.where(F.col("node_type") == target)

    def ranks(n: int) -> list[int]:
        val = round(val_share * n)
        return [val, val + round(test_share * n)]

    val_cut, test_cut = _unique_cuts(labelled, ["key"], seed, ranks)
    hashed = seeded_hash(seed, "key")
    split = (
        F.when(F.col("node_type") != target, F.lit(None))
        .when(_below(hashed, val_cut), "val")
        .when(_below(hashed, test_cut), "test")
        .otherwise("train")
    )
    return nodes.withColumn("split", split)


def pick_seeds(
    nodes: DataFrame, node_type: str, idx: int | None = None, count: int = 1, seed: int = 42
) -> DataFrame:
    """The node with a given index if it exists, else a sample of ``min(count, available)`` nodes."""
    typed = nodes.where(F.col("node_type") == node_type)
    if idx is not None:
        return typed.where(F.col("idx") == idx)
    (cut,) = _unique_cuts(typed, ["key"], seed, lambda _: [count])
    return typed.where(_below(seeded_hash(seed, "key"), cut))
