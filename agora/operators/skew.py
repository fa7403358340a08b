"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY_SHARE = 0.002
SAMPLE_SHARE = 0.01
MIN_SAMPLED = 30
SALTS = 64
_SALT = "_salt"


def heavy_keys(df: DataFrame, columns: Sequence[str], share: float = HEAVY_SHARE) -> dict[str, list]:
    """For every column, the values that hold more than ``share`` of a sample of the rows.

    Only the choice of values to spread depends on the sample, never a result.
    At most ``1 / share`` values of a column can pass, and small tables, which
    need no spreading, have none.
    """
    sample = df.select(*columns).sample(SAMPLE_SHARE, seed=1)
    # One job for all columns: counts per value of each column, and the total as the empty set.
    counts = sample.groupingSets([[c] for c in columns] + [[]], *columns).agg(
        F.count(F.lit(1)).alias("_n"), *[F.grouping(c).alias(f"_without_{c}") for c in columns]
    )
    most = len(columns) * (math.ceil(1 / share) + 1) + 1  # values above the share, NULL groups, the total
    rows = counts.where(F.col("_n") >= MIN_SAMPLED).orderBy(F.desc("_n")).limit(most).collect()
    total = max((r["_n"] for r in rows), default=0)

    def heavy(r, c):
        return r[f"_without_{c}"] == 0 and r[c] is not None and r["_n"] > share * total

    return {c: [r[c] for r in rows if heavy(r, c)] for c in columns}


def salted_join(
    facts: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    hot: list | None = None,
    hot_column: str | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join in which heavy fact keys are spread over ``salts`` partitions.

    Only the dimension rows of heavy keys are repeated, so the copies are
    bounded by ``len(hot) * salts`` for a dimension with unique keys. NULL fact
    keys match nothing: inner and semi joins drop them, left joins spread them.
    """
    keys = [on] if isinstance(on, str) else list(on)
    hot_column = hot_column or keys[-1]
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    if how != "left":
        facts = facts.where(~missing)
        dim = dim.where(~missing)
    if hot is None:
        hot = heavy_keys(facts, [hot_column])[hot_column]
    heavy: Column = F.col(hot_column).isin(hot) if hot else F.lit(False)
    spread = F.when(heavy | missing, F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    if not hot and how != "left":
        return facts.join(dim, keys, how)
    left = facts.withColumn(_SALT, F.coalesce(spread, F.lit(0)))
    copies = F.when(heavy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = dim.where(~missing).withColumn(_SALT, F.explode(copies))
    return left.join(right, [*keys, _SALT], how).drop(_SALT)


@dataclass(frozen=True)
class Bucketed:
    """A stored table whose files are bucketed and sorted by ``key``, so that joins on it need not move its rows."""

    frame: DataFrame
    key: str
    buckets: int
    hot: list  # heavy values of the key


def bucketed_join(facts: Bucketed, dim: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Inner equi-join of some columns of a bucketed table with ``dim``, which alone is shuffled, to the table's buckets.

    The rows of heavy keys would make a bucket long; only these are spread as
    in ``salted_join``.
    """
    rows = facts.frame.select(*columns)
    heavy = F.col(facts.key).isin(facts.hot) if facts.hot else F.lit(False)
    met = rows.where(~heavy).join(dim.where(~heavy).repartition(facts.buckets, facts.key), facts.key)
    if not facts.hot:
        return met
    return met.unionByName(salted_join(rows.where(heavy), dim.where(heavy), facts.key, "inner", facts.hot))
