"""Near-duplicate documents by a chosen-path set similarity join.

A document is its set of distinct shingles of five words. Documents with equal sets are one class from the start. A
class is embedded as ``COORDINATES`` minwise tokens. A tree sends every class down the paths that the tree's random
choices select: the root selects ``ROOT_FAN`` tokens, every later node one token and with some chance a second, so that
a pair at the threshold shares one child on average. Classes with the same selected token are together in a node. Nodes
of at most ``SMALL`` classes are compared exhaustively; in larger ones every class is compared with a few pivots, the
class that meets most others in the tree's nodes and random ones, and the node is branched again unless all its classes
are already connected. Independent trees are repeated until a pair at
the threshold is found with probability ``recall``.

Only pairs of classes that are not yet connected are compared, first by their tokens, then on their full sets. So a
group of thousands of near copies costs a few comparisons for each member, and no link between its members is needed
beyond those that connect it. Pairs of one neighbourhood are verified in blocks: a set travels once for each block of
partners, not for each pair. The token filter misses a pair at the threshold with probability ``FILTER_RISK``, and a pair
clearly above it practically never.

Defined cases: null and empty texts have no shingles and are linked with nothing. Rows without an id belong to the
class of their text; they are kept only if no document of the class has an id. Rows that share an id are judged each by
its own text. Extra columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.llm.components import connected_components
from agora.llm.hashing import chunks, mix, shingle_sets, texts_of, word_hashes
from agora.operators.skew import salted_join
from agora.session import materialize, materialize_counted

SHINGLE = 5
COORDINATES = 128
ROOT_FAN = 2
SMALL = 2048
RANDOM_PIVOTS = 3
FILTER_RISK = 1e-6
BLOCK = 512  # classes on either side of a block of pairs
FILTER_BITS = 1 << 26  # of the filter that finds the texts whose sets are compared: 8 MB
FEW = 1 << 20  # classes whose ids are broadcast to pick their sets: 8 MB
_PIECE_BITS = 1 << 15  # of a bitmap of Spark
DEEPEST = 40  # a node that is still large here is compared exhaustively; its size halves long before
_RNG = np.random.Generator(np.random.PCG64(31337))
_XOR = _RNG.integers(0, 2**64, COORDINATES, dtype=np.uint64)
_ODD = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Similarity:
    """Sets are linked if 100 * intersection >= ``percent`` * union."""

    percent: int = 85
    recall: float = 0.999999

    @property
    def share(self) -> float:
        return self.percent / 100

    @property
    def trees(self) -> int:
        """Trees that find a pair at the threshold with probability ``recall``, if its nodes branch twice."""
        second = 1 / self.share - 1  # chance of a second token
        child = self.share * (1 - (1 - self.share) * second)
        miss = (1 - self.share * child) ** ROOT_FAN
        return max(1, min(31, math.ceil(math.log(1 - self.recall) / math.log(miss))))

    def least_equal(self, tokens: int, risk: float) -> int:
        """Most k such that a linked pair has fewer than k of ``tokens`` in common with at most this chance."""
        total, k = 0.0, 0
        while k < tokens:
            total += math.comb(tokens, k) * self.share**k * (1 - self.share) ** (tokens - k)
            if total > risk:
                break
            k += 1
        return k


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = texts_of(batch.column(1))
        for at, end in chunks(offsets):
            words, bounds = word_hashes(data, offsets, at, end)
            sets = list(shingle_sets(words, bounds, SHINGLE))
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            full = np.flatnonzero(sizes)
            tokens = np.zeros((len(sets), COORDINATES), dtype=np.uint32)
            identity = np.zeros((len(sets), 2), dtype=np.uint64)
            if len(full):
                joined = np.concatenate([sets[i] for i in full])
                begins = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                for t in range(COORDINATES):
                    least = np.minimum.reduceat((joined ^ _XOR[t]) * _ODD[t], begins)
                    tokens[full, t] = (least >> np.uint64(32)).astype(np.uint32)
                identity[full, 0] = np.add.reduceat(mix(joined + np.uint64(1)), begins)
                identity[full, 1] = np.add.reduceat(mix(joined ^ _XOR[0]), begins)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, tokens.size + 1, COORDINATES, dtype=np.int32)), pa.array(tokens.view(np.int32).ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(at, end - at),
                    pa.array(sizes),
                    pa.array(identity[:, 0].view(np.int64)),
                    pa.array(identity[:, 1].view(np.int64)),
                    lists,
                ],
                names=["doc_id", "n_shingles", "set1", "set2", "tokens"],
            )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = texts_of(batch.column(1))
        for at, end in chunks(offsets):
            words, bounds = word_hashes(data, offsets, at, end)
            sets = list(shingle_sets(words, bounds, SHINGLE))
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = np.concatenate([np.sort(x.view(np.int64)) for x in sets])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, end - at), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))],
                names=["rep", "shingles"],
            )


CLASS = ["set1", "set2", "n_shingles"]


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, the set's identity in 128 bits, and its minwise tokens, for every row."""
    slim = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_shingles long, set1 long, set2 long, tokens array<int>"
    return slim.mapInArrow(_sketches, schema)


def _root(rule: Similarity) -> Column:
    """Every tree selects its own tokens at the root."""
    nodes = [F.xxhash64(F.lit(i // ROOT_FAN), F.lit(i), F.col("tokens")[i]) for i in range(rule.trees * ROOT_FAN)]
    return F.explode(F.array(*nodes))


def _children(rule: Similarity) -> Column:
    """One selected token for each node, and with chance 1 / threshold - 1 a second."""
    pick = [F.pmod(F.xxhash64("node", F.lit(k)), F.lit(COORDINATES)).cast("int") for k in (1, 2)]
    child = [F.xxhash64("node", i, F.element_at("tokens", i + 1)) for i in pick]
    second = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1 << 20)) < int((1 / rule.share - 1) * (1 << 20))
    return F.explode(F.when(second, F.array(*child)).otherwise(F.array(child[0])))


def _nodes(rows: DataFrame, label: str) -> DataFrame:
    """Rows (node, rep, size) of nodes with two classes or more."""
    sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return materialize(rows.join(sizes, "node"), label)


def _ranked(score: Column, *tie: str) -> Column:
    """One number to order by: a score, then a hash. Numbers keep the aggregation in hash tables."""
    return score.cast("long") * (1 << 20) + F.pmod(F.xxhash64(*tie), F.lit(1 << 20))


def _with_pivots(rows: DataFrame) -> DataFrame:
    """Add ``pivots`` to (node, rep, size): the class of the node that meets most others, and random ones.

    A text from which many copies were made meets most of them, whereas two copies may meet seldom.
    """
    met = rows.groupBy("rep").agg(F.sum("size").alias("met"))
    chosen = rows.join(met, "rep").groupBy("node").agg(
        F.max_by("rep", _ranked(F.col("met"), "rep")).alias("central"),
        *[F.min_by("rep", F.xxhash64("node", "rep", F.lit(k))).alias(f"p{k}") for k in range(RANDOM_PIVOTS)],
    )
    pivots = F.array_distinct(F.array("central", *[f"p{k}" for k in range(RANDOM_PIVOTS)]))
    return rows.join(chosen.select("node", pivots.alias("pivots")), "node")


def _groups(frames: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Frames sorted by ``columns``, cut into groups of equal values; a group may span frames."""
    held: pd.DataFrame | None = None
    for frame in frames:
        if not len(frame):
            continue
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        values = frame[columns].to_numpy()
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for lo, hi in zip([0, *cuts[:-1]], cuts):
            yield frame.iloc[lo:hi]
        held = frame.iloc[cuts[-1] if len(cuts) else 0 :]
    if held is not None:
        yield held


def _partners(group: pd.DataFrame, rule: Similarity) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of a block, the later rows that its tokens may link to it, in another component."""
    least, percent = rule.least_equal(COORDINATES, FILTER_RISK), rule.percent
    component, sizes, side = (group[c].to_numpy() for c in ("component", "n_shingles", "side"))
    tokens = np.array(group["tokens"].tolist(), dtype=np.int32)
    one_block = group["low"].iloc[0] == group["high"].iloc[0]
    for i in range(len(group) - 1):
        good = (component[i + 1 :] != component[i]) & ((side[i + 1 :] != side[i]) | one_block)
        good &= np.minimum(sizes[i + 1 :], sizes[i]) * 100 >= np.maximum(sizes[i + 1 :], sizes[i]) * percent
        rest = np.flatnonzero(good) + i + 1
        if len(rest):
            rest = rest[(tokens[rest] == tokens[i]).sum(axis=1) >= least]
            if len(rest):
                yield i, rest


def _is_link(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    spots = np.searchsorted(one, two)
    both = int((one[np.minimum(spots, len(one) - 1)] == two).sum())
    return 100 * both >= percent * (len(one) + len(two) - both)


def _sets_of(sets: DataFrame, reps: DataFrame, most: int) -> DataFrame:
    """The sets that ``reps`` (at most ``most`` rows) ask for: the others are left where they lie."""
    if most > FEW:
        return sets
    return sets.join(F.broadcast(reps.select("rep").distinct()), "rep", "left_semi")


def _exhaustive(rows: DataFrame, near: DataFrame, sets: DataFrame, rule: Similarity) -> DataFrame:
    """Links (a, b) between components among all classes of a hub, for rows (hub, rep, component).

    Nodes with one hub are compared as one. Its classes are dealt into blocks of about ``BLOCK``, and every two blocks
    meet in a group of their own. Tokens tell which classes have a possible partner there; only their sets follow. Of
    the links between two components one is enough.
    """
    members = rows.select("hub", "rep", "component").distinct()
    hubs = members.groupBy("hub").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"), F.min("component").alias("least"), F.max("component").alias("most")
    )
    # One hub may hold most classes.
    placed = salted_join(members, hubs.where("least <> most").select("hub", "blocks"), "hub")
    placed = placed.withColumn("side", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    place = ["hub", "low", "high"]
    placed = placed.select("hub", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "rep", "component")

    def needed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(frames, place):
            wanted = np.zeros(len(group), dtype=bool)
            for i, rest in _partners(group, rule):
                wanted[i] = True
                wanted[rest] = True
            if wanted.any():
                yield group[wanted]

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(frames, place):
            reps, component, shingles = (group[c].to_numpy() for c in ("rep", "component", "shingles"))
            found: dict[tuple, tuple] = {}
            for i, rest in _partners(group, rule):
                for j in rest:
                    between = (min(component[i], component[j]), max(component[i], component[j]))
                    if between not in found and _is_link(shingles[i], shingles[j], rule.percent):
                        found[between] = (min(reps[i], reps[j]), max(reps[i], reps[j]))
            if found:
                yield pd.DataFrame(list(found.values()), columns=["a", "b"])

    kind = near.schema["rep"].dataType.simpleString()
    columns = f"hub {kind}, low long, high long, side long, rep {kind}, component {kind}, n_shingles long, tokens array<int>"
    sketched = placed.join(near.select("rep", "n_shingles", "tokens"), "rep").select(*place, "side", "rep", "component", "n_shingles", "tokens")
    dealt = sketched.repartition(*place).sortWithinPartitions(*place)
    candidates, seen = materialize_counted(dealt.mapInPandas(needed, columns), "candidates", n=F.count(F.lit(1)))
    dealt = candidates.join(_sets_of(sets, candidates, seen["n"]), "rep").repartition(*place).sortWithinPartitions(*place)
    return dealt.mapInPandas(judge, f"a {kind}, b {kind}")


def _starred(pairs: DataFrame, near: DataFrame, rule: Similarity) -> DataFrame:
    """Candidates (a, b, na, nb, hub) among pairs (rep, pivot, hub)."""
    pairs = pairs.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b"), "hub").where("a <> b").distinct()
    tokens = near.select("rep", "n_shingles", "tokens")
    of = {x: tokens.select(*[F.col(c).alias(v) for c, v in zip(tokens.columns, (x, f"n{x}", f"t{x}"))]) for x in "ab"}
    found = pairs.join(of["a"], "a").join(of["b"], "b")
    equal = F.size(F.filter(F.zip_with("ta", "tb", lambda x, y: x == y), lambda e: e))
    found = found.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * rule.percent)
    return found.where(equal >= rule.least_equal(COORDINATES, FILTER_RISK)).select("a", "b", "na", "nb", "hub")


def _verified(candidates: DataFrame, sets: DataFrame, rule: Similarity) -> DataFrame:
    """The candidates (a, b) that are linked, judged on their full sets, block by block."""
    percent = rule.percent
    once = candidates.groupBy("a", "b").agg(F.min("hub").alias("hub"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    once, seen = materialize_counted(once, "candidates", n=F.count(F.lit(1)))
    members = once.select("hub", F.col("a").alias("rep")).unionByName(once.select("hub", F.col("b").alias("rep"))).distinct()
    blocks = members.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"))
    x, y = (F.pmod(F.xxhash64(c), F.col("blocks")) for c in "ab")
    placed = salted_join(once, blocks, "hub").withColumn("x", F.least(x, y)).withColumn("y", F.greatest(x, y))
    place = ["hub", "x", "y"]
    ends = placed.select(*place, F.col("a").alias("rep")).unionByName(placed.select(*place, F.col("b").alias("rep"))).distinct()
    kind = sets.schema["rep"].dataType.simpleString()
    held = ends.join(_sets_of(sets, members, 2 * seen["n"]), "rep").select(*place, F.lit(0).alias("what"), F.col("rep").alias("a"), F.col("rep").alias("b"), "shingles")
    asked = placed.select(*place, F.lit(1).alias("what"), "a", "b", F.lit(None).cast("array<long>").alias("shingles"))

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(frames, place):
            whole = group["what"].to_numpy() == 0
            own: dict = {}
            for rep, shingles in zip(group["a"][whole], group["shingles"][whole]):
                own.setdefault(rep, []).append(np.asarray(shingles))
            out = []
            pairs = group[~whole]
            for a, b in zip(pairs["a"], pairs["b"]):
                if any(_is_link(one, two, percent) for one in own[a] for two in own[b]):
                    out.append((a, b))
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])

    rows = held.unionByName(asked).repartition(*place).sortWithinPartitions(*place, "what")
    return materialize(rows.mapInPandas(judge, f"a {kind}, b {kind}").distinct(), "verified")


def _joined(known: DataFrame, links: DataFrame) -> DataFrame:
    """(rep, component) after ``links`` (a, b): whole components are joined, of which there are few."""
    of = [known.select(F.col("rep").alias(x), F.col("component").alias(f"c{x}")) for x in "ab"]
    between = links.join(of[0], "a").join(of[1], "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    tops = connected_components(between).select(F.col("node").alias("component"), "label")
    joined = known.join(tops, "component", "left").select("rep", F.coalesce("label", "component").alias("component"))
    return materialize(joined, "components")


def _marks(reps: DataFrame) -> np.ndarray | None:
    """A bit for each hash of an id in ``reps``, 1 if some id has it; None if there are too many for a filter to pay.

    The bits are ``FILTER_BITS`` at any size. Spark merges them in pieces of 4 KB before the driver puts them together.
    """
    if reps.count() > FILTER_BITS // 8:
        return None
    spot = F.pmod(F.xxhash64("rep"), F.lit(FILTER_BITS))
    pieces = reps.groupBy((F.bitmap_bucket_number(spot)).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bits"))
    out = np.zeros((FILTER_BITS // _PIECE_BITS + 2, _PIECE_BITS // 8), dtype=np.uint8)
    for r in pieces.collect():  # bounded: FILTER_BITS
        out[r["piece"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def _near_sets(docs: DataFrame, near: DataFrame) -> DataFrame:
    """rep and shingles of the documents that represent a class in ``near``, read where the texts lie.

    Of the other documents a few may pass the filter; no class asks for their sets.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select(F.col("doc_id").alias("rep"), "text").where("rep is not null")
    marks = _marks(near)
    if marks is None:
        # As many classes as texts, nearly: they are merged.
        chosen = texts.join(near.hint("merge"), "rep", "left_semi")
        return chosen.mapInArrow(_full_sets, f"rep {kind}, shingles array<long>")
    shared = docs.sparkSession.sparkContext.broadcast(marks)
    spot = F.pmod(F.xxhash64("rep"), F.lit(FILTER_BITS))
    hashed = texts.select("rep", "text", F.bitmap_bucket_number(spot).alias("piece"), F.bitmap_bit_position(spot).alias("bit"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value

        def passing() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                piece, bit = batch.column("piece").to_numpy(), batch.column("bit").to_numpy()
                good = (marks[piece, bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
                if good.any():
                    yield batch.select(["rep", "text"]).filter(pa.array(good.astype(bool)))

        yield from _full_sets(passing())

    return hashed.mapInArrow(sets, f"rep {kind}, shingles array<long>")


def class_links(docs: DataFrame, classes: DataFrame, rule: Similarity) -> DataFrame:
    """(rep, component) of every class that is linked with another; ``classes`` has rep, n_shingles and tokens."""
    rows = _nodes(classes.select("rep", _root(rule).alias("node")), "nodes")
    picks = rule.trees * ROOT_FAN
    # A linked class shares most selected tokens with its partner; one with few shared nodes has no partner.
    least = rule.least_equal(picks, 1e-7)
    reps = rows.groupBy("rep").count().where(F.col("count") >= least).select("rep")
    near = materialize(classes.join(reps, "rep"), "near")
    rows = rows.join(near.select("rep").distinct(), "rep", "left_semi").select("node", "rep", "size")
    rows = materialize(_with_pivots(rows), "pivots")
    sets = materialize(_near_sets(docs, near.select("rep").distinct()), "sets")

    # First every class with the pivot that it meets most often: that connects most groups.
    met = rows.select("rep", F.explode("pivots").alias("pivot")).where("rep <> pivot")
    met = met.groupBy("rep", "pivot").agg(F.count(F.lit(1)).alias("times"))
    first = met.groupBy("rep").agg(F.max_by("pivot", _ranked(F.col("times"), "pivot")).alias("pivot"))
    links = _verified(_starred(first.withColumn("hub", F.col("pivot")), near, rule), sets, rule)
    known = _joined(near.select("rep", F.col("rep").alias("component")).distinct(), links)

    for level in range(1, DEEPEST + 1):
        rows = rows.select("node", "rep", "size", "pivots").join(known, "rep")
        mixed = rows.groupBy("node").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
        open_rows = rows.join(mixed.select("node"), "node", "left_semi").withColumn("hub", F.col("pivots")[0])
        small = F.col("size") <= (SMALL if level < DEEPEST else (1 << 62))
        open_rows, seen = materialize_counted(open_rows, "open-nodes", small=F.count_if(small), large=F.count_if(~small))
        if not seen["small"] and not seen["large"]:
            break
        large = open_rows.where(~small)
        heads = known.select(F.col("rep").alias("pivot"), F.col("component").alias("cp"))
        stars = large.select("rep", "component", "hub", F.explode("pivots").alias("pivot")).distinct()
        stars = stars.join(heads, "pivot").where("component <> cp").select("rep", "pivot", "hub")
        links = _exhaustive(open_rows.where(small), near, sets, rule)
        if seen["large"]:
            links = links.unionByName(_verified(_starred(stars, near, rule), sets, rule))
        links, linked = materialize_counted(links.distinct(), "linked", n=F.count(F.lit(1)))
        if linked["n"]:
            known = _joined(known, links)
        if not seen["large"]:
            break
        deeper = large.select("node", "rep").join(near.select("rep", "tokens"), "rep")
        rows = _nodes(deeper.select("rep", _children(rule).alias("node")).distinct(), "nodes")
        rows = materialize(_with_pivots(rows), "pivots")
    return known


def near_duplicates(docs: DataFrame, rule: Similarity = Similarity()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, with the set's identity (set1, set2), for every row."""
    rows = materialize(sketches(docs), "sketches")
    own = rows.where("n_shingles > 0 and doc_id is not null")
    classes = own.groupBy(*CLASS).agg(F.min("doc_id").alias("rep"), F.first("tokens").alias("tokens"))
    classes = materialize(classes, "classes")
    labels = class_links(docs, classes, rule)
    of_class = classes.select(*CLASS, "rep").join(labels, "rep", "left")
    of_class = of_class.select(*CLASS, F.coalesce("component", "rep").alias("component_id"))
    out = rows.drop("tokens").join(of_class, CLASS, "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"),
        "set1",
        "set2",
    )


def document_components(docs: DataFrame, rule: Similarity = Similarity()) -> DataFrame:
    """The result of the query."""
    return near_duplicates(docs, rule).drop("set1", "set2")


def drop_near_duplicates(docs: DataFrame, rule: Similarity = Similarity()) -> DataFrame:
    """One row of each component, with all columns of ``docs``; rows without shingles all stay."""
    found = near_duplicates(docs, rule).where("kept").select("doc_id").distinct()
    packed = docs.select("doc_id", F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    joined = packed.join(found, packed["doc_id"].eqNullSafe(found["doc_id"]), "left_semi")
    once = joined.dropDuplicates(["doc_id", "row"])
    return once.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
