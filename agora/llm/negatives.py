"""Hard-negative mining with Kronecker-packed products.

Components are integers, floor(``SCALE`` * x). The candidates of a block are packed by component: component d of all of
them becomes one wide integer, candidate j in field j, biased so that no field is negative. For an anchor, each wide
integer is multiplied once, by the anchor's component d; their sum holds in field j the inner product with candidate j,
off by a known bias. Fields are as wide as the largest possible sum needs, so no field runs into the next one and the
scores that are unpacked are exact. Fields of up to 64 bits take 8, 16, 32 or 64 of them: none crosses a 64-bit word, no
word carries into the next, and the words of a wide integer are multiplied by many anchors at a time.

An anchor's positives are its best rows of the same label; each positive bounds the scores of its negatives, which are the
best rows of other labels within these bounds. A block holds rows of one label, so a search for positives reads the blocks
of its label and a search for negatives the others. Blocks are dealt to stripes and anchors to groups; a stripe and a group
meet in one cell, so both sides are repeated only as often as the other side is cut, and no cell grows with one label.
Both sides are shuffled to as many tasks as the pairs need. Neither is broadcast: the planner knows their size without the
copies only, which are far larger, and would deal the work by bytes.
Every row is scored against every anchor that may need it: nothing is pruned by an index, so nothing is missed.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component take no part; nor do components
of 2**24 / ``SCALE`` or more in magnitude, whose products would not fit the scores. Vectors of different lengths are
compared over the shorter length, as if padded with zeros; empty ones score 0. Rows that repeat an id are rows of their
own, as anchors, positives and negatives; a row is never its own positive. Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.operators.skew import salted_join
from agora.session import materialize

SCALE = 256
BLOCK = 1024  # candidates of a wide integer
ANCHORS = 256  # anchors that meet a block at a time
CELL = 1 << 23  # pairs of a cell, as long as there are at most CELLS
CELLS = 256  # then cells grow, up to 64 times: fewer copies travel
ROWS = 1 << 17  # rows, copies included, that a task gets at most on average
SPREAD = 1024  # tasks up to which there are four for each cell, so that a task seldom gets two
LARGEST = float(1 << 24)
FEW_LABELS = 50_000  # labels whose counts are broadcast; more are joined


# ---- Wide integers

WORD = 8  # bytes


def field_bytes(candidates: np.ndarray, largest_anchor: int) -> int:
    """Bytes of a field that holds any sum of biased products, and its sign."""
    if not candidates.size:
        return 1
    reach = int(candidates.max()) - int(candidates.min())
    most = max(1, candidates.shape[1] * reach * largest_anchor)
    width = (most.bit_length() + 1 + 7) // 8
    return width if width > WORD else 1 << (width - 1).bit_length()


def pack(candidates: np.ndarray, width: int) -> tuple[list[bytes], int]:
    """The wide integer of each component, as little-endian bytes, and the bias that was added to every component."""
    bias = -int(candidates.min()) if candidates.size else 0
    fields = np.zeros((candidates.shape[1], candidates.shape[0], 8), dtype=np.uint8)
    fields[:] = np.ascontiguousarray((candidates + bias).T.astype("<u8")).view(np.uint8).reshape(fields.shape)
    if width <= 8:
        return [f[:, :width].tobytes() for f in fields], bias
    wide = np.zeros((*fields.shape[:2], width), dtype=np.uint8)
    wide[:, :, :8] = fields
    return [f.tobytes() for f in wide], bias


class Packed:
    """Candidates of a block, ready to be multiplied."""

    def __init__(self, components: list[bytes], count: int, width: int, bias: int) -> None:
        self.count, self.width, self.bias = count, width, bias
        # Half a field in every field: no sum is negative, so none borrows from the next field.
        self.half = 1 << (8 * width - 1)
        if width > WORD:
            self.numbers = [int.from_bytes(c, "little") for c in components]
            self.halves = int.from_bytes(self.half.to_bytes(width, "little") * count, "little")
            return
        padded = np.zeros((len(components), -(-count * width // WORD) * WORD), dtype=np.uint8)
        for k, c in enumerate(components):
            padded[k, : len(c)] = np.frombuffer(c, dtype=np.uint8)
        self.words = padded.view("<u8")
        self.halves = int.from_bytes(self.half.to_bytes(width, "little") * (WORD // width), "little")

    def scores(self, anchor: list[int]) -> np.ndarray:
        """Exact inner products of ``anchor`` with all candidates."""
        return self.all_scores(np.array([anchor], dtype=np.int64))[0]

    def all_scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products of each row of ``anchors`` with all candidates."""
        if self.width > WORD:
            found = [self._wide(anchor) for anchor in anchors.tolist()]
            return np.array(found, dtype=np.int64).reshape(len(found), self.count)
        shared = min(anchors.shape[1], len(self.words))
        own = np.ascontiguousarray(anchors[:, :shared])
        # All modulo 2**64: a field holds its sum, and the scores themselves fit into 63 bits.
        total = np.einsum("ad,dw->aw", own.view("<u8"), self.words[:shared]) + np.uint64(self.halves)
        fields = total.view(f"<u{self.width}")[:, : self.count].astype("<u8")
        known = (self.bias * own.sum(axis=1)).view("<u8") + np.uint64(self.half)
        return (fields - known[:, None]).view("<i8")

    def _wide(self, anchor: list[int]) -> np.ndarray:
        total, shared = self.halves, 0
        for a, number in zip(anchor, self.numbers):
            if a:
                total += a * number
                shared += a
        fields = np.frombuffer(total.to_bytes(self.count * self.width, "little"), dtype=np.uint8).reshape(self.count, self.width)
        low = np.ascontiguousarray(fields[:, :WORD]).view("<u8").ravel()
        return (low - np.uint64((self.half + self.bias * shared) % (1 << 64))).view("<i8")


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties by smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= least)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]


# ---- Spark


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Lists of integers as rows, padded with zeros."""
    lengths = lists.value_lengths().to_numpy()
    matrix = np.zeros((len(lengths), int(lengths.max(initial=0))), dtype=np.int64)
    matrix[np.arange(matrix.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy()
    return matrix


def usable_rows(vectors: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    """row, key, label and integer components of the rows that take part, written once."""
    x = F.col("_x")
    fit = F.forall(x, lambda v: F.coalesce(F.abs(v) * SCALE < LARGEST, F.lit(False)) & ~F.isnan(v))
    rows = vectors.select(F.col(key).cast("long").alias("key"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("_x"))
    rows = rows.where(F.col("key").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & F.coalesce(fit, F.lit(False)))
    whole = F.transform(x, lambda v: F.floor(v * SCALE).cast("int")).alias("parts")
    return materialize(rows.select(F.monotonically_increasing_id().alias("row"), "key", "label", whole), "integers")


def _blocks(rows: DataFrame, labels: DataFrame, n_labels: int, largest: int) -> DataFrame:
    """Blocks of packed candidates of one label; ``labels`` has n, the rows of each label."""
    sizes = labels.select("label", F.ceil(F.col("n") / (BLOCK * 3 // 4)).alias("blocks"))
    known = rows.join(F.broadcast(sizes), "label") if n_labels <= FEW_LABELS else salted_join(rows, sizes, "label")
    dealt = known.withColumn("block", F.pmod(F.xxhash64("row"), "blocks"))
    grouped = dealt.groupBy("label", "block").agg(F.collect_list(F.struct("row", "key", "parts")).alias("rows"))
    schema = "label long, block long, rows array<bigint>, keys array<bigint>, width int, bias bigint, components array<binary>"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, block, members in zip(*(batch.column(c) for c in ("label", "block", "rows"))):
                own = members.values
                matrix = _matrix(own.field("parts"))
                width = field_bytes(matrix, largest)
                components, bias = pack(matrix, width)
                values = [label.as_py(), block.as_py(), own.field("row").to_numpy(), own.field("key").to_numpy(), width, bias, components]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _PACKED)], schema=_PACKED)

    return materialize(grouped.mapInArrow(packed, schema), "packed")


_PACKED = pa.schema(
    [
        ("label", pa.int64()), ("block", pa.int64()), ("rows", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64())),
        ("width", pa.int32()), ("bias", pa.int64()), ("components", pa.list_(pa.binary())),
    ]
)


def _cells(pairs: int) -> int:
    cells = max(1, math.ceil(pairs / CELL))
    return cells if cells <= CELLS else max(CELLS, math.ceil(pairs / (64 * CELL)))


def _cut(candidates: int, anchors: int) -> tuple[int, int]:
    """Stripes of candidates and groups of anchors: cells of about equal sides, so that little is repeated."""
    cells = _cells(candidates * anchors)
    groups = min(max(1, round(math.sqrt(cells * anchors / max(1, candidates)))), max(1, anchors))
    return max(1, math.ceil(cells / groups)), groups


def _tasks(pairs: int, rows: int) -> int:
    """Tasks for so many pairs, and rows with their copies."""
    least = max(_cells(pairs), math.ceil(rows / ROWS))
    return max(least, min(4 * least, SPREAD))


def _met(blocks: DataFrame, anchors: DataFrame, cut: tuple[int, int], own_label: bool, tasks: int) -> DataFrame:
    """Blocks beside the chunks of anchors that they are to be scored with, dealt to ``tasks``."""
    stripes, groups = cut
    dealt = anchors.withColumn("group", F.pmod(F.xxhash64("anchor_row"), F.lit(groups)).cast("int"))
    keys = ["group", "label"] if own_label else ["group"]
    members = [c for c in dealt.columns if c not in keys]
    # Chunks of bounded size: a group's anchors by their number in it.
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("anchor_row")) - 1
    chunks = dealt.withColumn("chunk", F.floor(place / ANCHORS)).groupBy(*keys, "chunk").agg(F.collect_list(F.struct(*members)).alias("anchors"))
    spread = chunks.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    striped = blocks.withColumn("stripe", F.pmod(F.xxhash64("label", "block"), F.lit(stripes)).cast("int"))
    striped = striped.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    on = ["stripe", "group", "label"] if own_label else ["stripe", "group"]
    return striped.repartition(tasks, *on).hint("merge").join(spread.repartition(tasks, *on), on)


def _scored(met: DataFrame, schema: str, pick) -> DataFrame:
    """Rows, as columns, that ``pick`` makes of a block, a chunk of anchors and the scores of one with the other."""
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, packed = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                r = {name: batch.column(name)[at] for name in batch.schema.names}
                here = (r["label"].as_py(), r["block"].as_py())
                if here != last:
                    keys = r["keys"].values.to_numpy()
                    rows = r["rows"].values.to_numpy()
                    last, packed = here, Packed([c.as_py() for c in r["components"]], len(keys), r["width"].as_py(), r["bias"].as_py())
                anchors = r["anchors"].values
                columns = pick(here[0], rows, keys, anchors, packed.all_scores(_matrix(anchors.field("parts"))))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    # One block at a time: a row holds a block and a chunk of anchors.
    return met.select("label", "block", "rows", "keys", "width", "bias", "components", "anchors").mapInArrow(score, schema)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def _ranked(found: DataFrame, by: list[str], score: str, key: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), key)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows where ``anchors`` (over key) holds.

    A negative's score is at least ``least`` and at most ``most`` percent of the positive's.
    """
    rows = usable_rows(vectors, key, vector, F.col("label") if label is None else label)
    reach = F.array_max(F.transform("parts", lambda v: F.abs(v)))
    asked = rows.where(anchors).select(F.col("row").alias("anchor_row"), F.col("key").alias("anchor_id"), "label", "parts")
    labels = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(anchors).alias("asked"))
    size = labels.agg(
        F.count(F.lit(1)).alias("labels"), F.sum("n").alias("n"), F.sum("asked").alias("asked"), F.max("n").alias("most"), F.max("asked").alias("most_asked"),
        F.sum(F.col("n") * F.col("asked")).alias("pairs"),
    ).first()
    if not size["asked"]:
        return vectors.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    largest = asked.agg(F.max(reach)).first()[0] or 0
    blocks = _blocks(rows, labels, size["labels"], largest)

    def nearest(block_label: int, block_rows: np.ndarray, keys: np.ndarray, anchors: pa.StructArray, scores: np.ndarray) -> list[np.ndarray]:
        asking, chosen = anchors.field("anchor_row").to_numpy(), []
        for row, own in zip(asking, scores):
            others = np.flatnonzero(block_rows != row)
            chosen.append(others[best(own[others], keys[others], positives)])
        of, top = np.repeat(np.arange(len(asking)), [len(c) for c in chosen]), _joined(chosen)
        return [asking[of], keys[top], scores[of, top], block_rows[top]]

    def dealt(pairs: int, cut: tuple[int, int]) -> int:
        return _tasks(pairs, size["n"] * cut[1] + size["asked"] * cut[0])

    cut = _cut(size["most"], max(1, size["most_asked"]))
    found = _scored(_met(blocks, asked, cut, True, dealt(size["pairs"], cut)), "anchor_row long, positive_id long, positive_score long, positive_row long", nearest)
    top = materialize(_ranked(found, ["anchor_row"], "positive_score", "positive_id", positives), "positives")
    chosen = top.groupBy("anchor_row").agg(F.collect_list(F.struct("rank", "positive_score")).alias("bounds"))
    # An anchor without positives needs no negatives.
    bounded = asked.withColumnRenamed("label", "anchor_label").join(chosen, "anchor_row").drop("anchor_id")

    def hard(block_label: int, block_rows: np.ndarray, keys: np.ndarray, anchors: pa.StructArray, scores: np.ndarray) -> list[np.ndarray]:
        asking, bounds = anchors.field("anchor_row").to_numpy(), anchors.field("bounds")
        of = np.repeat(np.arange(len(asking)), bounds.value_lengths().to_numpy())
        rank, positive = (bounds.flatten().field(c).to_numpy() for c in ("rank", "positive_score"))
        low, high = -(-least * positive // 100), most * positive // 100
        kept = np.flatnonzero((low <= high) & (anchors.field("anchor_label").to_numpy()[of] != block_label))
        kept = kept[np.argsort(of[kept], kind="stable")]
        of, rank, low, high = of[kept], rank[kept], low[kept], high[kept]
        own, first = np.unique(of, return_index=True)
        bounded, chosen = [], []
        if len(own):
            inside = scores[own] >= np.minimum.reduceat(low, first)[:, None]
            inside &= scores[own] <= np.maximum.reduceat(high, first)[:, None]
            ends = np.append(first[1:], len(of))
            for k in np.flatnonzero(inside.any(axis=1)):
                some = np.flatnonzero(inside[k])
                down = -scores[own[k], some]
                order = np.lexsort((keys[some], down))
                some, down = some[order], down[order]
                mine = np.arange(first[k], ends[k])
                start = np.searchsorted(down, -high[mine], "left")
                end = np.minimum(np.searchsorted(down, -low[mine], "right"), start + negatives)
                for m, a, b in zip(mine.tolist(), start.tolist(), end.tolist()):
                    if a < b:
                        bounded.append(np.full(b - a, m))
                        chosen.append(some[a:b])
        bound, found = _joined(bounded), _joined(chosen)
        return [asking[of[bound]], rank[bound], keys[found], scores[of[bound], found]]

    cut = _cut(size["n"], size["asked"])
    found = _scored(_met(blocks, bounded, cut, False, dealt(size["n"] * size["asked"], cut)), "anchor_row long, positive_rank long, negative_id long, negative_score long", hard)
    ranked = _ranked(found, ["anchor_row", "positive_rank"], "negative_score", "negative_id", negatives)
    named = top.withColumnRenamed("rank", "positive_rank").join(asked.select("anchor_row", "anchor_id"), "anchor_row")
    return ranked.join(named, ["anchor_row", "positive_rank"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """The result of the query: anchors are the ids divisible by 50; ids divisible by 7 get the next label."""
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id").cast("long") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(vectors, F.col("key") % 50 == 0, label=label)


ORACLE = """
with rows as (
  select row_number() over () as row, vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as parts
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
  select a.row as anchor_row, a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_dot_product(a.parts, c.parts)::bigint as score
  from rows a join rows c on a.row <> c.row where a.vec_id % 50 = 0
), positives as (
  select *, row_number() over (partition by anchor_row order by score desc, vec_id) as k from pairs where same
), negatives as (
  select p.anchor_row, p.k, p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
         row_number() over (partition by p.anchor_row, p.k order by n.score desc, n.vec_id) as rank
  from positives p join pairs n on n.anchor_row = p.anchor_row and not n.same
  where p.k <= 5 and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from negatives where rank <= 3
"""
