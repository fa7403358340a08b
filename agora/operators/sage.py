"""Relation-wise graph convolution over DataFrames of nodes and edges.

A layer gives every node ``sum over incoming relations of
W_neighbor * mean(neighbours) + bias + W_self * own``. Neighbour values are
vectors: they are summed per relation as vectors before the shuffle to their
destination and again behind it, so a hub is a few rows for each task and the
plan does not depend on the width. The linear maps run in the task that adds up
a node's sums, as one matrix product for each Arrow batch. Between the layers
a node travels as its means, which are narrow; its hidden values are computed
where they are added up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.catalog import ALL_TYPES, INDEX_BITS, Profile, node_id, typed_id
from agora.functions.scoring import cross_entropy, graph_class, positive_probability
from agora.operators.graph_build import Graph
from agora.operators.skew import heavy_keys, salted_join
from agora.operators.vectors import by_key, lists_of, partial_sums, summed, sums_batch, whole_sums

Parameters = dict[str, np.ndarray]


def parameter_shapes(profile: Profile, width: int = 1, hidden: int = 32, classes: int = 2) -> dict[str, tuple[int, ...]]:
    """Names and shapes of all weights that can reach the target's output.

    The second layer and the head exist for the target type only: outputs of
    other types are never used, so weights of theirs would never change.
    """
    shapes: dict[str, tuple[int, ...]] = {}
    for _, relation, _ in profile.edge_types:
        shapes[f"conv1/{relation}/neighbor"] = (hidden, width)
        shapes[f"conv1/{relation}/bias"] = (hidden,)
        shapes[f"conv1/{relation}/self"] = (hidden, width)
    for relation in profile.incoming(profile.target):
        shapes[f"conv2/{relation}/neighbor"] = (hidden, hidden)
        shapes[f"conv2/{relation}/bias"] = (hidden,)
        shapes[f"conv2/{relation}/self"] = (hidden, hidden)
    shapes["head/weight"] = (classes, hidden)
    shapes["head/bias"] = (classes,)
    return shapes


def init_parameters(shapes: dict[str, tuple[int, ...]], seed: int = 42) -> Parameters:
    """Uniform in +-1/sqrt(fan-in), as is usual for linear layers."""
    rng = np.random.default_rng(seed)
    fan_in = {name.rpartition("/")[0]: shape[1] for name, shape in shapes.items() if len(shape) == 2}
    result = {}
    for name, shape in shapes.items():
        bound = 1.0 / np.sqrt(fan_in[name.rpartition("/")[0]])
        result[name] = rng.uniform(-bound, bound, shape)
    return result


def _stacked(params: Parameters, layer: str, relations: Sequence[str], slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights of one destination type, side by side: one block per relation, then own values."""
    blocks = [params[f"{layer}/{r}/neighbor"] for r in relations]
    blocks += [np.zeros_like(blocks[0])] * (slots - len(blocks))
    own = sum(params[f"{layer}/{r}/self"] for r in relations)
    bias = sum(params[f"{layer}/{r}/bias"] for r in relations)
    return np.hstack([*blocks, own]), bias


def _messages(
    features: DataFrame, nodes: DataFrame, edges: DataFrame, profile: Profile, incoming: dict[str, list[str]], hot: list
) -> DataFrame:
    """(_dst, slot, kind, x): the source's type and the values that reach each wanted node, by relation; own values come in the last slot.

    ``incoming`` lists the relations of each wanted destination type and ``nodes`` the destinations.
    """
    slots = max(len(r) for r in incoming.values())
    # One branch per relation, with constant types. A node's own values travel as one
    # more edge, so that features are computed once.
    branches = []
    for src_type, relation, dst_type in profile.edge_types:
        if relation in incoming.get(dst_type, []):
            branches.append(
                edges.where(F.col("relation") == relation).select(
                    typed_id(dst_type, "dst").alias("_dst"),
                    F.lit(incoming[dst_type].index(relation)).alias("slot"),
                    typed_id(src_type, "src").alias("_src"),
                )
            )
    node = node_id("node_type", "idx")
    own = nodes.where(F.col("node_type").isin(list(incoming)))
    branches.append(own.select(node.alias("_dst"), F.lit(slots).alias("slot"), node.alias("_src")))
    pairs = reduce(DataFrame.unionAll, branches)
    met = salted_join(pairs, features.select(node.alias("_src"), "x"), "_src", "inner", hot)
    return met.select("_dst", "slot", F.shiftright("_src", INDEX_BITS).cast("int").alias("kind"), "x")


Maps = dict[int, tuple[np.ndarray, np.ndarray]]  # type number -> weights and bias
_HIDDEN = -1  # kind of a row that holds sums of hidden values


def _maps(params: Parameters, layer: str, incoming: dict[str, list[str]]) -> Maps:
    slots = max(len(r) for r in incoming.values())
    return {ALL_TYPES.index(t): _stacked(params, layer, relations, slots) for t, relations in incoming.items()}


def _linear(kinds: np.ndarray, values: np.ndarray, maps: Maps) -> np.ndarray:
    """The linear map of each row's type, and ReLU."""
    out = np.zeros((len(kinds), len(next(iter(maps.values()))[1])))
    for number, (weight, bias) in maps.items():
        chosen = kinds == number
        if chosen.any():
            out[chosen] = np.maximum(values[chosen] @ weight.T + bias, 0.0)
    return out


def _means(dst: np.ndarray, slot: np.ndarray, n: np.ndarray, x: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and, side by side, the means of their slots."""
    starts = np.flatnonzero(np.r_[True, dst[1:] != dst[:-1]])
    means = np.zeros((len(starts), slots + 1, x.shape[1]))
    means[np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(dst)])), slot] = x / n[:, None]
    return dst[starts], means.reshape(len(starts), -1)


def _node_rows(nodes: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    names = np.array(ALL_TYPES, dtype=object)[nodes >> INDEX_BITS]
    columns = [pa.array(names, pa.string()), pa.array(nodes & ((1 << INDEX_BITS) - 1)), lists_of(values)]
    return pa.RecordBatch.from_arrays(columns, names=["node_type", "idx", "x"])


_SHORT = pa.schema([("_dst", pa.int64()), ("slot", pa.int32()), ("kind", pa.int32()), ("n", pa.int64()), ("x", pa.list_(pa.float64()))])
_NODE_ROWS = "node_type string, idx bigint, x array<double>"


def neighbor_means(
    features: DataFrame, nodes: DataFrame, edges: DataFrame, profile: Profile, incoming: dict[str, list[str]], hot: list, width: int
) -> DataFrame:
    """Of each node the means of its in-neighbours by relation, and its own values last."""
    slots = max(len(r) for r in incoming.values())

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_sums(batches, width):
            yield _node_rows(*_means(*rows, slots))

    sums = partial_sums(_messages(features, nodes, edges, profile, incoming, hot), width)
    return by_key(sums).mapInArrow(transform, _NODE_ROWS)


def hidden_layer(
    means: DataFrame,
    nodes: DataFrame,
    edges: DataFrame,
    profile: Profile,
    first: Maps,
    second: Maps,
    incoming: dict[str, list[str]],
    hot: dict[str, list],
    head: tuple[np.ndarray, np.ndarray],
) -> DataFrame:
    """Outputs of the head for ``nodes`` from the means that the first layer's map is applied to.

    Means are shuffled to their destinations. Those of a destination with very
    many edges are turned into sums of hidden values before, in each Arrow batch.
    """
    slots = max(len(r) for r in incoming.values())
    size = len(next(iter(first.values()))[1])
    hubs = pa.array(hot["dst"], pa.int64())

    def summed_hidden(rows: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        dst, slot, kind, n = (rows.column(c).to_numpy() for c in ("_dst", "slot", "kind", "n"))
        x, values = rows.column("x"), np.zeros((rows.num_rows, size))
        done = kind == _HIDDEN
        if done.any():
            values[done] = x.filter(pa.array(done)).flatten().to_numpy().reshape(-1, size)
        if not done.all():
            narrow = x.filter(pa.array(~done)).flatten().to_numpy().reshape(int((~done).sum()), -1)
            values[~done] = _linear(kind[~done], narrow, first)
        return summed(dst, slot, n, values)

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            # All batches of a stream have one schema.
            rows = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(given.columns, _SHORT)], schema=_SHORT)
            of_hub = pc.is_in(rows.column("_dst"), value_set=hubs)
            if not pc.any(of_hub).as_py():
                yield rows
                continue
            yield rows.filter(pc.invert(of_hub))
            dst, slot, n, x = summed_hidden(rows.filter(of_hub))
            kind = np.full(len(dst), _HIDDEN, dtype=np.int32)
            columns = [pa.array(dst), pa.array(slot.astype(np.int32)), pa.array(kind), pa.array(n), lists_of(x)]
            yield pa.RecordBatch.from_arrays(columns, schema=_SHORT)

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = (sums_batch(*summed_hidden(rows)) for rows in batches if rows.num_rows)
        for rows in whole_sums(sums, size):
            found, values = _means(*rows, slots)
            yield _node_rows(found, _linear(found >> INDEX_BITS, values, second) @ head[0].T + head[1])

    messages = _messages(means, nodes, edges, profile, incoming, hot["src"])
    rows = messages.select("_dst", "slot", "kind", F.lit(1).cast("bigint").alias("n"), "x")
    short = rows.mapInArrow(shorten, "_dst bigint, slot int, kind int, n bigint, x array<double>")
    return by_key(short).mapInArrow(transform, _NODE_ROWS)


def forward(graph: Graph, params: Parameters, split: str | None = None) -> DataFrame:
    """Logits (idx, z0, z1) of the target nodes, or of one split of them, over all neighbours.

    The second layer reads only the relations that end in the target type.
    """
    profile = graph.profile
    incoming = {t: profile.incoming(t) for t in profile.node_types}
    target = profile.target
    ends = graph.edges.select(node_id("src_type", "src").alias("src"), node_id("dst_type", "dst").alias("dst"))
    hot = heavy_keys(ends, ["src", "dst"])
    width = params[f"conv1/{incoming[target][0]}/neighbor"].shape[1]
    means = neighbor_means(graph.nodes, graph.nodes, graph.edges, profile, incoming, hot["src"], width)
    wanted = graph.nodes.where(F.col("node_type") == target)
    edges = graph.edges.where(F.col("dst_type") == target)
    if split is not None:
        wanted = wanted.where(F.col("split") == split)
        chosen = wanted.select(node_id("node_type", "idx").alias("_dst"))
        edges = edges.withColumn("_dst", node_id("dst_type", "dst"))
        edges = salted_join(edges, chosen, "_dst", "left_semi", hot["dst"])
    into = {target: incoming[target]}
    first, second = _maps(params, "conv1", incoming), _maps(params, "conv2", into)
    head = (params["head/weight"], params["head/bias"])
    last = hidden_layer(means, wanted, edges, profile, first, second, into, hot, head)
    return last.select("idx", F.get("x", F.lit(0)).alias("z0"), F.get("x", F.lit(1)).alias("z1"))


def predict(graph: Graph, params: Parameters, split: str | None = None) -> DataFrame:
    """Probability, class and label of the target nodes, or of one split of them."""
    logits = forward(graph, params, split)
    labels = graph.nodes.where(F.col("node_type") == graph.profile.target).select("idx", "key", F.col("y").alias("label"))
    prob = positive_probability(F.col("z0"), F.col("z1"))
    return (
        logits.join(labels, "idx")
        .withColumn("prob", prob)
        .withColumn("pred", graph_class(F.col("prob")))
        .withColumn("loss", cross_entropy(F.col("z0"), F.col("z1"), F.col("label")))
    )
