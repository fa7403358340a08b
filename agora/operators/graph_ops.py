"""Operators on typed graphs: reverses, self loops, validation, degrees, ego graphs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.catalog import SELF_LOOP, Profile, index_of, node_id, reverse_name, type_of
from agora.operators.graph_build import Graph
from agora.operators.ordering import index_rows
from agora.operators.sampling import node_split
from agora.operators.skew import Bucketed, bucketed_join, heavy_keys, salted_join
from agora.session import materialize

EDGE_KEYS = ["src_type", "relation", "dst_type"]
WORDS = 16  # 64-bit words of a block of seeds that share their nodes: 1024 seeds; others have one word
SHARED = 2  # seeds at a node, on average, from which they share it


def relations_of(edges: DataFrame) -> list[tuple[str, str, str]]:
    """The (source, relation, destination) types present; as many as the catalogue has."""
    return sorted(tuple(r) for r in edges.select(*EDGE_KEYS).distinct().collect())


def reverse_edges(edges: DataFrame, profile: Profile, present: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Add every relation's reverse unless an edge type of that name exists already. ``present`` are the types, if known."""
    present = relations_of(edges) if present is None else present
    result = edges
    for src_type, relation, dst_type in present:
        name = reverse_name(profile.name, relation)
        if (dst_type, name, src_type) in present:
            continue
        # One branch per relation: readers of a single relation skip all other branches.
        of_type = (F.col("src_type") == src_type) & (F.col("relation") == relation) & (F.col("dst_type") == dst_type)
        flipped = edges.where(of_type).select(
            F.lit(dst_type).alias("src_type"),
            F.lit(name).alias("relation"),
            F.lit(src_type).alias("dst_type"),
            F.col("dst").alias("src"),
            F.col("src").alias("dst"),
        )
        result = result.unionByName(flipped)
    return result


def self_loops(nodes: DataFrame, target: str) -> DataFrame:
    return nodes.where(F.col("node_type") == target).select(
        F.lit(target).alias("src_type"),
        F.lit(SELF_LOOP).alias("relation"),
        F.lit(target).alias("dst_type"),
        F.col("idx").alias("src"),
        F.col("idx").alias("dst"),
    )


def prepare(graph: Graph, val_share: float = 0.1, test_share: float = 0.1, seed: int = 42) -> Graph:
    """Graph ready for a model: split of the labelled nodes, reverse relations, self loops.

    All three are computed row by row from the stored graph whenever it is read.
    """
    nodes = node_split(graph.nodes, graph.profile.target, val_share, test_share, seed)
    present = relations_of(graph.edges)
    edges = reverse_edges(graph.edges, graph.profile, present).unionByName(self_loops(nodes, graph.profile.target))
    return Graph(graph.profile, nodes, edges, _mirrors(present, graph.profile))


def _mirrors(present: list[tuple[str, str, str]], profile: Profile) -> dict[tuple[str, str, str], tuple[str, str, str]]:
    """The mirrors of a prepared graph. Where a type was there before ``prepare`` made edges of it, nothing is known."""
    loop = (profile.target, SELF_LOOP, profile.target)
    reverse = {(s, r, d): (d, reverse_name(profile.name, r), s) for s, r, d in present}
    mirrors = {**reverse, **{v: k for k, v in reverse.items()}, loop: loop}
    return mirrors if len(mirrors) == 2 * len(present) + 1 else {}


def catalogue_check(edges: DataFrame, profile: Profile) -> DataFrame:
    """Edges per relation and whether the profile knows the relation."""
    known = reduce(
        lambda a, b: a | b,
        [
            (F.col("src_type") == s) & (F.col("relation") == r) & (F.col("dst_type") == d)
            for s, r, d in profile.edge_types
        ],
    )
    counts = edges.groupBy(*EDGE_KEYS).agg(F.count(F.lit(1)).alias("edges"))
    return counts.withColumn("known", known)


def validate(graph: Graph) -> Graph:
    unknown = [r for r in relations_of(graph.edges) if r not in graph.profile.edge_types]
    if unknown:
        raise ValueError(f"relations outside the {graph.profile.name} profile: {unknown}")
    return graph


def degree_summary(edges: DataFrame) -> DataFrame:
    """For every relation: edges, distinct ends, and the largest out- and in-degree."""

    def by_end(end: str, ends: str, largest: str) -> DataFrame:
        degrees = edges.groupBy(*EDGE_KEYS, end).agg(F.count(F.lit(1)).alias("degree"))
        return degrees.groupBy(*EDGE_KEYS).agg(
            F.sum("degree").alias("edges"),
            F.count(F.lit(1)).alias(ends),
            F.max("degree").alias(largest),
        )

    outgoing = by_end("src", "sources", "max_out_degree")
    return outgoing.join(by_end("dst", "destinations", "max_in_degree").drop("edges"), EDGE_KEYS)


def multigraph_view(graph: Graph) -> DataFrame:
    """Nodes and edges as one table of typed items; parallel edges stay apart."""
    nodes = graph.nodes.select(
        F.lit("node").alias("item"),
        F.col("node_type").alias("src_type"),
        F.lit(None).cast("string").alias("relation"),
        F.lit(None).cast("string").alias("dst_type"),
        F.col("idx").alias("src"),
        F.lit(None).cast("bigint").alias("dst"),
    )
    return nodes.unionByName(graph.edges.select(F.lit("edge").alias("item"), *EDGE_KEYS, "src", "dst"))


def induced_edges(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Edges whose two ends are both in ``members`` (node_type, idx). An edge travels as its relation and two numbers."""
    inside = members.select(node_id("node_type", "idx").alias("_node"))
    ends = _with_ends(edges).select("relation", "_src", "_dst")
    hot = heavy_keys(ends, ["_src", "_dst"])
    kept = ends
    for end in ("_src", "_dst"):
        kept = salted_join(kept, inside.withColumnRenamed("_node", end), end, "left_semi", hot[end])
    return kept.select(
        type_of("_src").alias("src_type"), "relation", type_of("_dst").alias("dst_type"),
        index_of("_src").alias("src"), index_of("_dst").alias("dst"),
    )


def _with_ends(edges: DataFrame) -> DataFrame:
    return edges.select("*", node_id("src_type", "src").alias("_src"), node_id("dst_type", "dst").alias("_dst"))


# Seeds are numbered, and seed n is bit n % 64 of word n // 64 % words of block n // (64 * words). A node that many seeds
# reach is one row for each block of seeds, and rows of one node merge by OR before and behind the shuffle.


def _word(k: int) -> str:
    return f"_w{k}"


def _marked(seeds: DataFrame, words: int) -> DataFrame:
    """(_node, _block, words) of numbered seeds."""
    bit = F.expr("shiftleft(1L, cast(_seed % 64 as int))")
    place = F.expr(f"_seed div 64 % {words}")
    marks = [F.bit_or(F.when(place == k, bit).otherwise(F.lit(0).cast("bigint"))).alias(_word(k)) for k in range(words)]
    block = F.expr(f"_seed div {64 * words}").alias("_block")
    return seeds.groupBy("_node", block).agg(*marks)


def _unmarked(marked: DataFrame, words: int, *columns: str) -> DataFrame:
    """One row for each set bit: the columns and the seed's number."""
    word = F.array(*[F.col(_word(k)) for k in range(words)])
    bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(F.col("_bits"), b) == 1)
    spread = marked.select("*", F.posexplode(word).alias("_k", "_bits")).where("_bits <> 0").withColumn("_bit", F.explode(bits))
    number = F.expr(f"_block * {64 * words} + _k * 64 + _bit").alias("_seed")
    return spread.select(*columns, number)


def _search(ends: DataFrame | Bucketed, seeds: DataFrame, radius: int, words: int, hot: list) -> DataFrame:
    """(_node, _block, hops, words): the seeds that reach each node first in that many hops.

    A round merges what the last round's nodes hand on with what is known, in
    one aggregation; its rows are bounded by the nodes for each block of seeds,
    however many seeds there are. Every round is written to shared storage.
    """
    names = [_word(k) for k in range(words)]
    found = materialize(_marked(seeds, words).withColumn("hops", F.lit(0)), "ego")
    frontier = found
    for hop in range(1, radius + 1):
        step = frontier.select(F.col("_node").alias("_src"), "_block", *names)
        handed = _along(ends, step, ["_src", "_dst"], hot)
        handed = handed.select(F.col("_dst").alias("_node"), "_block", *names, F.lit(True).alias("_new"))
        both = handed.unionByName(found.select("_node", "_block", *names, F.lit(False).alias("_new")))
        nothing = F.lit(0).cast("bigint")
        sums = [F.bit_or(F.when(F.col("_new"), F.col(w)).otherwise(nothing)).alias(w) for w in names]
        sums += [F.bit_or(F.when(F.col("_new"), nothing).otherwise(F.col(w))).alias(f"_old{w}") for w in names]
        merged = both.groupBy("_node", "_block").agg(*sums)
        fresh = [F.col(w).bitwiseAND(F.bitwise_not(F.col(f"_old{w}"))).alias(w) for w in names]
        new = merged.select("_node", "_block", *fresh).where(reduce(lambda a, b: a | b, [F.col(w) != 0 for w in names]))
        frontier = materialize(new.withColumn("hops", F.lit(hop)), "ego")
        found = found.unionByName(frontier)
    return found


def _along(ends: DataFrame | Bucketed, step: DataFrame, columns: list[str], hot: list) -> DataFrame:
    """Edges that leave the nodes of ``step`` (by _src)."""
    if isinstance(ends, Bucketed):
        return bucketed_join(ends, step, columns)
    return salted_join(ends.select(*columns), step, "_src", "inner", hot)


def _numbered(seeds: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Seeds as (_seed, _node), their names (_seed, seed_id), and the words of a block.

    Where seeds share their nodes a node is reached by many of them and blocks
    are large. Seeds at nodes of their own mostly reach different nodes: a row
    for each seed then holds one word, not ``WORDS`` that are nearly all 0.
    """
    given = materialize(seeds.select("seed_id", node_id("node_type", "idx").alias("_node")).distinct(), "seeds")
    indexed = index_rows(given.select("seed_id").distinct(), ["seed_id"], name="_seed")
    names = indexed.frame
    places, starts = given.agg(F.count(F.lit(1)), F.count_distinct("_node")).first()
    shared = places >= SHARED * starts
    words = max(1, min(WORDS, -(-indexed.total // 64))) if shared else 1
    return given.join(names, "seed_id").select("_seed", "_node"), names, words


def _named(found: DataFrame, names: DataFrame, *columns) -> DataFrame:
    # A seed may reach a large part of the graph.
    return salted_join(found, names, "_seed").select("seed_id", *columns)


def ego_nodes(edges: DataFrame | Bucketed, seeds: DataFrame, radius: int = 2) -> DataFrame:
    """Nodes within ``radius`` outgoing hops of each seed, with their distance.

    ``seeds`` has seed_id, node_type, idx. All seeds are searched at once: what
    travels is a node with the bits of its seeds, not a row for each seed. The
    stored out-edges of a graph stay where they are.
    """
    numbered, names, words = _numbered(seeds)
    if isinstance(edges, Bucketed):
        return _ego_nodes(_search(edges, numbered, radius, words, edges.hot), names, words)
    ends = _with_ends(edges)
    found = _search(ends, numbered, radius, words, heavy_keys(ends, ["_src"])["_src"])
    return _ego_nodes(found, names, words)


def _ego_nodes(found: DataFrame, names: DataFrame, words: int) -> DataFrame:
    spread = _unmarked(found, words, "_node", "hops")
    return _named(spread, names, type_of("_node").alias("node_type"), index_of("_node").alias("idx"), "hops")


def ego_graph(edges: DataFrame | Bucketed, seeds: DataFrame, radius: int = 2) -> tuple[DataFrame, DataFrame]:
    """Ego nodes and, for each seed, the edges among them including parallel ones.

    An edge belongs to the seeds whose bits both of its ends have.
    """
    ends = edges if isinstance(edges, Bucketed) else _with_ends(edges)
    hot = heavy_keys(edges.frame if isinstance(edges, Bucketed) else ends, ["_src", "_dst"])
    numbered, names, words = _numbered(seeds)
    found = _search(ends, numbered, radius, words, hot["_src"])
    columns = [_word(k) for k in range(words)]
    reached = materialize(found.groupBy("_node", "_block").agg(*[F.bit_or(w).alias(w) for w in columns]), "ego")
    sources = reached.withColumnRenamed("_node", "_src")
    targets = reached.select(F.col("_node").alias("_dst"), "_block", *[F.col(w).alias(f"_to{w}") for w in columns])
    edge = [*EDGE_KEYS, "src", "dst"]
    inside = _along(ends, sources, [*edge, "_src", "_dst"], hot["_src"])
    inside = salted_join(inside, targets, ["_block", "_dst"], "inner", hot["_dst"], "_dst")
    shared = [F.col(w).bitwiseAND(F.col(f"_to{w}")).alias(w) for w in columns]
    marked = inside.select(*edge, "_block", *shared)
    return _ego_nodes(found, names, words), _named(_unmarked(marked, words, *edge), names, *edge)
