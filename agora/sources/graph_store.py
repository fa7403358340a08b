"""Graphs as Parquet: partitioned so that readers touch only the types they need, or bucketed so that joins need no shuffle."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.catalog import Profile, index_of, node_id
from agora.operators.graph_build import EDGE_SCHEMA, NODE_SCHEMA, Graph
from agora.operators.graph_ops import EDGE_KEYS
from agora.operators.skew import Bucketed, heavy_keys


def write_graph(graph: Graph, path: str) -> None:
    graph.nodes.write.parquet(f"{path}/nodes", mode="overwrite", partitionBy="node_type")
    graph.edges.write.parquet(f"{path}/edges", mode="overwrite", partitionBy="relation")


def _pruned(df: DataFrame, column: str, wanted: Sequence[str] | None) -> DataFrame:
    return df if wanted is None else df.where(F.col(column).isin(list(wanted)))


def read_graph(
    spark: SparkSession,
    path: str,
    profile: str,
    node_types: Sequence[str] | None = None,
    relations: Sequence[str] | None = None,
) -> Graph:
    """Read a graph back, or only some node types and relations of it."""
    nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes")
    edges = spark.read.schema(EDGE_SCHEMA).parquet(f"{path}/edges")
    return Graph(Profile(profile), _pruned(nodes, "node_type", node_types), _pruned(edges, "relation", relations))


@dataclass(frozen=True)
class StoredGraph:
    """A graph whose tables are bucketed: nodes by ``_node``, edges once by ``_src`` and once by ``_dst``."""

    profile: Profile
    nodes: Bucketed
    out_edges: Bucketed
    in_edges: Bucketed


BUCKET_ROWS = 2_000_000
_KEYS = {"nodes": "_node", "out_edges": "_src", "in_edges": "_dst"}


def _table(name: str, part: str) -> str:
    return f"{name}_{part}"


def _slim_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes as they are shuffled: without index, and with the key as a number where it is the usual text of one."""
    number = F.col("key").try_cast("bigint")
    usual = F.coalesce(number.cast("string") == F.col("key"), F.lit(False))
    keys = [F.when(usual, number).alias("_number"), F.when(~usual, F.col("key")).alias("_text")]
    return nodes.select("node_type", *keys, "x", "y", "split", node_id("node_type", "idx").alias("_node"))


def _full_key() -> Column:
    return F.coalesce("_text", F.col("_number").cast("string")).alias("key")


def _number_of(types: Sequence[tuple[str, str, str]]) -> Column:
    """The place of an edge's type among ``types``."""
    number = F.lit(None).cast("int")
    for k, values in enumerate(types):
        same = [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(EDGE_KEYS, values)]
        number = F.when(same[0] & same[1] & same[2], F.lit(k)).otherwise(number)
    return number


def _named(types: Sequence[tuple[str, str, str]]) -> list[Column]:
    """The names of the type at a place among ``types``."""
    return [F.get(F.array(*[F.lit(t[k]).cast("string") for t in types]), F.col("_type")).alias(c) for k, c in enumerate(EDGE_KEYS)]


@contextmanager
def _whole_buckets(spark: SparkSession) -> Iterator[None]:
    """Scans of bucketed tables read a bucket in a task, also where no join asks for it."""
    setting = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def write_bucketed(graph: Graph, path: str, name: str, buckets: int = 64) -> None:
    """Store a graph below ``path`` as tables ``name``_nodes, _out_edges and _in_edges, bucketed and sorted by their keys.

    Every edge is stored twice, by either end. A bucket is written by one task
    into one file: there are at least ``buckets``, and more where one would
    hold over ``BUCKET_ROWS`` edges. Indices are stored as parts of the ids.

    An edge is shuffled as the number of its type and two ids, a node with its
    key as a number. If every edge has its reverse in the graph, the bucket of
    a node's out-edges holds its in-edges the other way round, and the second
    table is written without a shuffle.
    """
    spark = graph.nodes.sparkSession
    counts = graph.edges.groupBy(*EDGE_KEYS).agg(F.count(F.lit(1)).alias("n")).collect()
    buckets = max(buckets, -(-sum(r["n"] for r in counts) // BUCKET_ROWS))
    types = sorted((tuple(r[c] for c in EDGE_KEYS) for r in counts), key=repr)

    def write(frame: DataFrame, part: str) -> None:
        writer = frame.write.format("parquet").mode("overwrite").option("path", f"{path}/{part}").option("compression", "zstd")
        writer.bucketBy(buckets, _KEYS[part]).sortBy(_KEYS[part]).saveAsTable(_table(name, part))

    nodes = _slim_nodes(graph.nodes).repartition(buckets, "_node")
    write(nodes.select("node_type", _full_key(), "x", "y", "split", "_node"), "nodes")
    ends = [node_id("src_type", "src").alias("_src"), node_id("dst_type", "dst").alias("_dst")]
    slim = graph.edges.select(_number_of(types).alias("_type"), *ends)
    write(slim.repartition(buckets, "_src").select(*_named(types), "_src", "_dst"), "out_edges")
    if types and all(t in graph.mirrors for t in types):
        flipped = [_number_of(types).alias("_type"), F.col("_dst").alias("_src"), F.col("_src").alias("_dst")]
        stored = spark.table(_table(name, "out_edges")).select(*flipped)
        with _whole_buckets(spark):
            write(stored.select(*_named([graph.mirrors[t] for t in types]), "_src", "_dst"), "in_edges")
    else:
        write(slim.repartition(buckets, "_dst").select(*_named(types), "_src", "_dst"), "in_edges")
    # Values that are heavy as an end of edges are known once the edges are stored.
    stored = spark.read.parquet(f"{path}/out_edges")
    hot = heavy_keys(stored, ["_src", "_dst"])
    layout = spark.createDataFrame([(buckets, hot["_src"], hot["_dst"])], "buckets int, src array<bigint>, dst array<bigint>")
    layout.coalesce(1).write.parquet(f"{path}/layout", mode="overwrite")


def open_bucketed(spark: SparkSession, path: str, name: str, profile: str) -> StoredGraph:
    """A graph stored by ``write_bucketed``; a session that doesn't know its tables registers them."""
    layout = spark.read.parquet(f"{path}/layout").first()
    heavy = {"nodes": [], "out_edges": layout["src"], "in_edges": layout["dst"]}
    found = {}
    for part, key in _KEYS.items():
        table = _table(name, part)
        if not spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{path}/{part}").schema.fields)
            spark.sql(
                f"create table {table} ({columns}) using parquet "
                f"clustered by ({key}) sorted by ({key}) into {layout['buckets']} buckets location '{path}/{part}'"
            )
        frame = spark.table(table)
        if part == "nodes":
            frame = frame.select("node_type", "key", index_of("_node").alias("idx"), "x", "y", "split", "_node")
        else:
            frame = frame.select(*EDGE_KEYS, index_of("_src").alias("src"), index_of("_dst").alias("dst"), "_src", "_dst")
        found[part] = Bucketed(frame, key, layout["buckets"], list(heavy[part]))
    return StoredGraph(Profile(profile), **found)
