"""Shards from a Feistel permutation of global row numbers.

The rows are numbered 0 to n-1 in the order of given keys. A keyed Feistel network permutes the smallest domain of an
even number of bits that holds n; positions outside 0 to n-1 are sent through it again (cycle walking), which leaves a
permutation of the row numbers. Shard and slot of a row follow from its number by arithmetic, so any row's place can be
computed without looking at the others.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.operators.ordering import index_rows

ROUNDS = 6
_GOLDEN = 0x9E3779B97F4A7C15
_MASK64 = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words, used as the round function."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def round_keys(seed: int, rounds: int = ROUNDS) -> np.ndarray:
    steps = [((seed + 1) * _GOLDEN * (i + 1)) & _MASK64 for i in range(rounds)]
    return _mix(np.array(steps, dtype=np.uint64))


def half_bits(n: int) -> int:
    return max(1, ((max(n, 1) - 1).bit_length() + 1) // 2)


def permute(rows: np.ndarray, n: int, seed: int = 0, inverse: bool = False) -> np.ndarray:
    """Places of row numbers in the permutation of 0..n-1; with ``inverse``, the row numbers of places."""
    bits = np.uint64(half_bits(n))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    keys = round_keys(seed)

    def network(x: np.ndarray) -> np.ndarray:
        left, right = x >> bits, x & mask
        if inverse:
            for key in keys[::-1]:
                left, right = right ^ (_mix(left ^ key) & mask), left
        else:
            for key in keys:
                left, right = right, left ^ (_mix(right ^ key) & mask)
        return (left << bits) | right

    out = np.asarray(rows).astype(np.uint64)
    if len(out) == 0:
        return out.astype(np.int64)
    outside = np.ones(len(out), dtype=bool)
    while outside.any():
        out[outside] = network(out[outside])
        outside = out >= np.uint64(n)
    return out.astype(np.int64)


def place_column(row: Column, n: int, seed: int) -> Column:
    @F.pandas_udf("long")
    def place(rows: pd.Series) -> pd.Series:
        return pd.Series(permute(rows.to_numpy(), n, seed))

    return place(row)


def shard_rows(
    df: DataFrame,
    order_by: Sequence[Column],
    shards: int = 8,
    seed: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """All rows and columns of ``df`` with ``row_number``, ``shard`` and ``slot`` (long, int, long).

    Counts of two shards differ by one at most and the slots of a shard run from 0 without gaps. ``order_by`` fixes
    the row numbers: nulls come first, and rows equal in all keys may trade places, so the keys should tell different
    rows apart. Columns of ``df`` that are called like a new one are replaced. An empty table stays empty.
    """
    keys = [f"key{i}" for i in range(len(order_by))]
    packed = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), *[c.alias(k) for c, k in zip(order_by, keys)])
    indexed = index_rows(packed, keys, name="row_number", spread_ties=True, partitions=partitions)
    n = indexed.total
    place = place_column(F.col("row_number"), n, seed)
    new = {"row_number", "shard", "slot"}
    kept = [F.col("row").getField(c).alias(c) for c in df.columns if c.lower() not in new]
    placed = indexed.frame.withColumn("place", place)
    shard = (F.col("place") % shards).cast("int").alias("shard")
    slot = F.expr(f"place div {shards}").alias("slot")
    return placed.select(*kept, "row_number", shard, slot)


def document_facts(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus one) and checksum; a null text has size 1 and no checksum."""
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 0) -> DataFrame:
    """The result of the query: one row for each document with its shard and slot, by the law ``rows``."""
    facts = document_facts(docs)
    placed = shard_rows(facts, [facts["doc_id"], facts["size"], facts["text_crc32"]], shards, seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
