"""Mixing of sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Every source gets a target number of words. Blocks of ``block`` words are seats: they go to the sources by highest
quotients target / (2 seats + 1), and in the same way from a source to its shards by the shards' words. A shard is a
seeded hash class of a source's documents; in it the documents are laid out in seeded order, block after block, and the
shard's seats take the blocks from the front, going round again when all are taken once.

A source has as many shards as its words ask for, so a hot source is spread; the driver holds one number for each source
and each shard, at most ``MOST_SHARDS`` for a source.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.text import SPACE, word_count
from agora.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
BLOCK = 16
SHARD_WORDS = 1 << 16
MOST_SHARDS = 4096


def targets(sizes: Sequence[int], weights: Sequence[float], share: float, most: float) -> list[float]:
    """Words for each source: ``share`` of all, by weight, none above ``most`` times its size."""
    out = [0.0] * len(sizes)
    left = share * sum(sizes)
    open_ = list(range(len(sizes)))
    while open_:
        total = sum(weights[i] for i in open_)
        shares = {i: left * weights[i] / total for i in open_}
        over = [i for i in open_ if shares[i] > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = shares[i]
            break
        for i in over:
            out[i] = most * sizes[i]
            left -= out[i]
        left = max(left, 0.0)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def sainte_lague(claims: Sequence[float], seats: int, most: Sequence[int]) -> list[int]:
    """Seats by highest quotients claim / (2 seats + 1); ties go to the earlier claim, ``most`` bounds each.

    A quotient found by bisection gives all seats of higher quotients at once; the rest are given one by one. That is
    the same as giving every seat by quotient, without a step for each.
    """
    seats = min(seats, sum(m for c, m in zip(claims, most) if c > 0))
    if seats <= 0:
        return [0] * len(claims)

    def reached(claim: float, quotient: float) -> int:
        """Seats whose quotients are at least ``quotient``."""
        n = max(0, math.floor((claim / quotient + 1) / 2))
        while n and claim / (2 * n - 1) < quotient:
            n -= 1
        while claim / (2 * n + 1) >= quotient:
            n += 1
        return n

    def given(quotient: float) -> list[int]:
        return [min(m, reached(c, quotient)) if c > 0 else 0 for c, m in zip(claims, most)]

    high = 2.0 * max(claims)  # gives nothing
    low = high
    while sum(given(low)) < seats:
        low /= 2
    for _ in range(200):
        mid = (low + high) / 2
        if not low < mid < high:
            break
        if sum(given(mid)) <= seats:
            high = mid
        else:
            low = mid
    out = given(high)
    heap = [(-c / (2 * s + 1), i) for i, (c, s, m) in enumerate(zip(claims, out, most)) if c > 0 and s < m]
    heapq.heapify(heap)
    for _ in range(seats - sum(out)):
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < most[i]:
            heapq.heappush(heap, (-claims[i] / (2 * out[i] + 1), i))
    return out


@dataclass(frozen=True)
class Mixture:
    weights: Sequence[float] = WEIGHTS  # for the sources in code point order, null last, repeating
    share: float = 1.5  # of all words
    most: float = 2.0  # times its size for a source, a shard and a document
    block: int = BLOCK
    shard_words: int = SHARD_WORDS
    seed: int = 0


def _source_key(source: Column) -> Column:
    """A key that is never null: null sources are a source of their own."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(""))


def take_words(
    docs: DataFrame,
    doc_id: Column,
    source: Column,
    text: Column,
    mixture: Mixture = Mixture(),
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``docs`` (or the columns ``keep`` of them) as struct ``row``, with ``size``, ``source_size``, ``target`` and ``taken``.

    ``taken`` counts words the mix takes of a row, repeats included; it is at most ``most`` times its size. Null and
    empty texts have size 0 and nothing is taken of them. A null source is a source of its own, the last one. Rows
    equal in id and text may trade places; nothing else depends on the layout of the input.
    """
    order = F.xxhash64(F.lit(mixture.seed), doc_id.cast("string"), text)
    packed = docs.select(
        F.struct(*[docs[c] for c in (docs.columns if keep is None else keep)]).alias("row"),
        _source_key(source).alias("source_key"),
        word_count(text).alias("size"),
        order.alias("order"),
    )
    sized = materialize(packed, "mix-sizes")
    totals = sized.groupBy("source_key").agg(F.sum("size").alias("words")).collect()
    # Python compares text by code point; the empty key is the null source and comes last.
    totals = sorted(totals, key=lambda r: (r["source_key"] == "", r["source_key"]))
    sizes = [r["words"] for r in totals]
    wanted = targets(sizes, [mixture.weights[i % len(mixture.weights)] for i in range(len(sizes))], mixture.share, mixture.most)
    most = [math.ceil(mixture.most * s / mixture.block) for s in sizes]
    seats = sainte_lague(wanted, round(sum(wanted) / mixture.block), most)
    plan = [
        (r["source_key"], r["words"], want, min(MOST_SHARDS, max(1, math.ceil(r["words"] / mixture.shard_words))), n)
        for r, want, n in zip(totals, wanted, seats)
    ]
    spark = docs.sparkSession
    sources = spark.createDataFrame(
        [p[:4] for p in plan], "source_key string, source_size long, target double, shards int"
    )
    # Bounded: one row for each source, which the driver holds anyway.
    dealt = sized.join(F.broadcast(sources), "source_key").withColumn(
        "shard", F.pmod(F.xxhash64("order"), F.col("shards").cast("long")).cast("int")
    )
    held: dict[str, list] = {p[0]: [] for p in plan}
    for r in dealt.groupBy("source_key", "shard").agg(F.sum("size").alias("words")).collect():
        held[r["source_key"]].append((r["shard"], r["words"]))
    quotas = []
    for key, _, _, _, n in plan:
        shards = sorted(held[key])
        caps = [math.ceil(mixture.most * w / mixture.block) for _, w in shards]
        for (shard, words), q in zip(shards, sainte_lague([w for _, w in shards], n, caps)):
            quotas.append((key, shard, words, min(q * mixture.block, math.floor(mixture.most * words))))
    quota = spark.createDataFrame(quotas, "source_key string, shard int, shard_size long, quota long")
    laid = Window.partitionBy("source_key", "shard").orderBy("order", "size")
    before = F.sum("size").over(laid.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    # Bounded: one row for each shard, MOST_SHARDS for each source; joined before the window's shuffle.
    placed = dealt.join(F.broadcast(quota), ["source_key", "shard"]).withColumn("before", before)
    laps = [
        F.least(F.col("size"), F.greatest(F.lit(0), F.col("quota") - F.col("before") - lap * F.col("shard_size")))
        for lap in range(math.ceil(mixture.most))
    ]
    taken = sum(laps[1:], laps[0]).cast("long").alias("taken")
    return placed.select("row", "size", "source_size", "target", taken)


def mix_documents(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """The mixed corpus itself, with the columns of ``docs`` (text, source and doc_id among them).

    A document of which all words are taken is a row as it is, once for each time; of one that is taken in part the
    row holds the first words, up to the last one taken, with their white space. ``n_chars`` follows the text.
    """
    taken = take_words(docs, docs["doc_id"], docs["source"], docs["text"], mixture)
    whole = F.expr("taken div size")
    rest = F.expr("taken % size")
    words = F.transform(F.sequence(F.lit(1), whole), lambda _: F.col("size"))
    words = F.when(whole > 0, words).otherwise(F.array().cast("array<bigint>"))
    words = F.concat(words, F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    rows = taken.where("taken > 0").select("row", "size", F.explode(words).alias("words"))
    text = F.col("row.text")
    pieces = F.regexp_extract_all(text, F.lit(f"[{SPACE}]*[^{SPACE}]+"), 0)
    cut = F.when(F.col("words") == F.col("size"), text).otherwise(
        F.array_join(F.slice(pieces, F.lit(1), F.col("words").cast("int")), "")
    )
    rows = rows.withColumn("cut", cut)
    new = {"text": F.col("cut"), "n_chars": F.char_length("cut")}
    return rows.select(
        *[
            (new[c].cast(docs.schema[c].dataType) if c in new else F.col("row").getField(c)).alias(c)
            for c in docs.columns
        ]
    )


def mixed_words(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """The result of the query: what the mix takes of every document."""
    taken = take_words(docs, docs["doc_id"], docs["source"], docs["text"], mixture, keep=["doc_id"])
    return taken.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")
