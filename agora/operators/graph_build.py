"""Typed nodes and edges from the cleaned tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType

from agora.catalog import FORUM, QA, Profile
from agora.functions.cleaning import nan_to_null, strip_post_prefix, to_id, to_number
from agora.operators.ordering import dense_index, index_rows
from agora.operators.skew import heavy_keys, salted_join
from agora.session import materialize

NODE_SCHEMA = "node_type string, key string, idx bigint, x array<double>, y int, split string"
EDGE_SCHEMA = "src_type string, relation string, dst_type string, src bigint, dst bigint"
FEW = 100_000  # repeated keys that are sent to the rows instead of moving the rows


@dataclass(frozen=True)
class Graph:
    profile: Profile
    nodes: DataFrame  # NODE_SCHEMA
    edges: DataFrame  # EDGE_SCHEMA
    # Edge type to edge type: every edge of the one has its reverse as an edge of the other. Empty if that isn't known of all edges.
    mirrors: dict[tuple[str, str, str], tuple[str, str, str]] = field(default_factory=dict)

    def with_edges(self, edges: DataFrame) -> Graph:
        return replace(self, edges=edges, mirrors={})

    def with_nodes(self, nodes: DataFrame) -> Graph:
        return replace(self, nodes=nodes)


def _whole(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, IntegralType)


def _typed(
    df: DataFrame, node_type: str, key: str, x: Column, y: Column | None = None, row_order: str | None = None
) -> DataFrame:
    """One row per key. Of repeated keys the last row by ``row_order`` wins.

    ``place`` is where the key first appears, or a numeric key itself; it
    decides the index. Without ``row_order`` repeats are settled by the values,
    and a whole number as a key is its place only: what is shuffled has no text
    of it, and ``key`` is NULL.
    """
    whole = row_order is None and _whole(df, key)
    label = F.lit(None).cast("int") if y is None else y.cast("int")
    place = F.col(row_order).cast("bigint") if row_order else F.lit(None).cast("bigint")
    rows = df.where(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint" if whole else "string").alias("key"),
        F.coalesce(x.cast("double"), F.lit(0.0)).alias("x"),
        label.alias("y"),
        place.alias("place"),
    )
    # Plain numbers in the buffers keep this a hash aggregation.
    if row_order:
        values = [F.max_by("x", "place").alias("x"), F.max_by("y", "place").alias("y"), F.min("place").alias("place")]
    else:
        values = [F.max("x").alias("x"), F.max("y").alias("y"), F.max("place").alias("place")]
    merged = rows.groupBy("key").agg(*values)
    text, place = F.col("key"), F.coalesce("place", F.col("key").try_cast("bigint"))
    if whole:
        text, place = F.lit(None).cast("string"), F.col("key")
    return merged.select(F.lit(node_type).alias("node_type"), text.alias("key"), "x", "y", place.alias("place"))


def _key() -> Column:
    return F.coalesce("key", F.col("place").cast("string")).alias("key")


def _as_nodes(indexed: DataFrame, node_type: str, x: Column) -> DataFrame:
    y = F.col("y") if "y" in indexed.columns else F.lit(None).cast("int").alias("y")
    return indexed.select(
        F.lit(node_type).alias("node_type"), F.col("key").cast("string").alias("key"), "idx",
        F.array(x).alias("x"), y, F.lit(None).cast("string").alias("split"),
    )


@dataclass(frozen=True)
class _Placed:
    """The nodes of one type and the rows they come from.

    ``rows`` has one row for each table row with a key: its node's index as
    ``own`` and the keys of other nodes. ``hot`` are heavy values of these keys.
    """

    nodes: DataFrame  # NODE_SCHEMA
    rows: DataFrame
    hot: dict[str, list]


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _placed(
    df: DataFrame,
    node_type: str,
    key: str,
    x: Column,
    y: Column | None = None,
    row_order: str | None = None,
    partitions: int | None = None,
    **others: Column,
) -> _Placed:
    """Dense index of a type: by first appearance or numeric key, then by key.

    By their keys, the rows are merged where the order puts them and take the
    other keys along, so they move once. Only rows of repeated keys, which may
    differ in these, look their index up; a heavy key is merged before it moves.
    """
    known = df.where(F.col(key).isNotNull())
    keyed = known.select(_probe(df, key).alias("key"), *[c.alias(name) for name, c in others.items()])
    hot = heavy_keys(keyed, ["key", *others])
    if row_order:
        indexed = dense_index(_typed(df, node_type, key, x, y, row_order), ["place", "key"], partitions=partitions)
        nodes = _as_nodes(indexed, node_type, F.col("x"))
        return _Placed(nodes, _own(keyed, nodes, node_type, hot), hot)

    values = {"x": F.coalesce(x.cast("double"), F.lit(0.0)), **({} if y is None else {"y": y.cast("int")}), **others}
    rows = known.select(_probe(df, key).alias("key"), *[c.alias(name) for name, c in values.items()])
    order = ["key"]
    if not _whole(df, key):
        rows, order = rows.withColumn("place", F.col("key").try_cast("bigint")), ["place", "key"]

    def merged(rows: DataFrame, count: Column) -> DataFrame:
        return rows.groupBy(*order).agg(*[F.max(name).alias(name) for name in values], count.alias("_n"))

    count = F.count(F.lit(1))
    if hot["key"]:
        heavy = F.col("key").isin(hot["key"])
        rows = rows.where(~heavy).withColumn("_n", F.lit(1).cast("bigint")).unionByName(merged(rows.where(heavy), count))
        count = F.sum("_n")
    indexed = index_rows(rows, order, partitions=partitions, merge=lambda ranged: merged(ranged, count)).frame
    nodes = _as_nodes(indexed, node_type, F.col("x"))
    if not others:
        return _Placed(nodes, indexed.select(F.col("idx").alias("own")), hot)
    found = indexed.where("_n = 1").select(F.col("idx").alias("own"), *others)
    repeated = indexed.where("_n > 1").select("key", F.col("idx").alias("own"))
    many = repeated.count()
    if many > FEW:
        found = found.unionByName(salted_join(keyed, repeated, "key", "inner", hot["key"]).drop("key"))
    elif many:
        # Bounded by FEW: the rows stay where they are.
        found = found.unionByName(keyed.join(F.broadcast(repeated), "key").drop("key"))
    return _Placed(nodes, found, hot)


def _own(keyed: DataFrame, nodes: DataFrame, node_type: str, hot: dict[str, list]) -> DataFrame:
    """Rows with the index of their own node, found by their key."""
    return salted_join(keyed, _ends(nodes, node_type, "key", "own", keyed), "key", "inner", hot["key"]).drop("key")


def _probe(df: DataFrame, key: str) -> Column:
    """A key as edges look it up: a whole number as such, anything else as text."""
    return F.col(key).cast("bigint" if _whole(df, key) else "string")


def _ends(nodes: DataFrame, node_type: str, key: str, name: str, rows: DataFrame | None = None) -> DataFrame:
    """Keys and indices of a type, the keys as numbers where ``rows`` look them up so."""
    typed = nodes.where(F.col("node_type") == node_type)
    if rows is not None and _whole(rows, key):
        number = F.col("key").try_cast("bigint")
        # Only the usual spelling is the text of a number.
        return typed.where(number.cast("string") == F.col("key")).select(number.alias(key), F.col("idx").alias(name))
    return typed.select(F.col("key").alias(key), F.col("idx").alias(name))


def _edges(found: DataFrame, relation: tuple[str, str, str]) -> DataFrame:
    names = [F.lit(v).alias(c) for c, v in zip(("src_type", "relation", "dst_type"), relation)]
    return found.select(*names, "src", "dst")


def _related(placed: _Placed, key: str, nodes: DataFrame, relation: tuple[str, str, str], own: str) -> DataFrame:
    """Edges of one relation: rows know their node, the ``own`` end, and the key of the other, which may be unknown."""
    src_type, _, dst_type = relation
    end, node_type = ("src", src_type) if own == "dst" else ("dst", dst_type)
    rows = placed.rows.select(F.col("own").alias(own), key)
    return _edges(salted_join(rows, _ends(nodes, node_type, key, end, rows), key, "inner", placed.hot[key]), relation)


def lookup_edges(
    rows: DataFrame, nodes: DataFrame, relation: tuple[str, str, str], src_key: str, dst_key: str
) -> DataFrame:
    """Edges of one relation: rows whose two keys are both known nodes."""
    src_type, _, dst_type = relation
    keyed = rows.select(F.col(src_key).cast("string").alias("s"), F.col(dst_key).cast("string").alias("d"))
    found = salted_join(keyed, _ends(nodes, src_type, "s", "src"), "s")
    found = salted_join(found, _ends(nodes, dst_type, "d", "dst"), "d")
    return _edges(found, relation)


def _asked(questions: DataFrame) -> dict[str, Column]:
    return {"user": _probe(questions, "user_id"), "accepted": to_id(F.col("accepted_answer_id"))}


def _given(answers: DataFrame) -> dict[str, Column]:
    return {"question": _probe(answers, "question_id"), "user": _probe(answers, "user_id")}


def qa_nodes(
    users: DataFrame,
    questions: DataFrame,
    answers: DataFrame,
    row_order: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Users (x = 1, labelled), questions and answers (x = score)."""
    placed = [
        _placed_users(users, row_order, partitions),
        _placed(questions, "question", "question_id", F.col("score"), None, row_order, partitions),
        _placed(answers, "answer", "answer_id", F.col("score"), None, row_order, partitions),
    ]
    return _union([p.nodes for p in placed])


def _placed_users(users: DataFrame, row_order: str | None, partitions: int | None = None) -> _Placed:
    return _placed(users, "user", "user_id", F.lit(1.0), F.col("influential"), row_order, partitions)


def qa_edges(nodes: DataFrame, asked: _Placed, given: _Placed) -> DataFrame:
    """asks, answers, has and accepted_answer of questions and answers that know their own index."""
    return _union(
        [
            _related(asked, "user", nodes, ("user", "asks", "question"), "dst"),
            _related(asked, "accepted", nodes, ("question", "accepted_answer", "answer"), "src"),
            _related(given, "user", nodes, ("user", "answers", "answer"), "dst"),
            _related(given, "question", nodes, ("question", "has", "answer"), "dst"),
        ]
    )


def qa_graph(users: DataFrame, questions: DataFrame, answers: DataFrame, row_order: str | None = None) -> Graph:
    """The nodes of ``qa_nodes`` and their edges."""
    asked = _placed(questions, "question", "question_id", F.col("score"), None, row_order, **_asked(questions))
    given = _placed(answers, "answer", "answer_id", F.col("score"), None, row_order, **_given(answers))
    nodes = _union([_placed_users(users, row_order).nodes, asked.nodes, given.nodes])
    edges = materialize(qa_edges(nodes, asked, given), "edges", ["relation"])
    return Graph(Profile(QA), nodes, edges)


def all_authors(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Distinct authors of posts and comments."""
    return posts.select("author").unionAll(comments.select("author")).where(F.col("author").isNotNull()).distinct()


def distinct_posts(posts: DataFrame, row_order: str | None = None) -> DataFrame:
    """One row per post id with the score of its last row."""
    rows = _typed(posts, "post", "post_id", to_number(F.col("score")), None, row_order)
    return rows.select(_key().alias("post_id"), F.col("x").alias("score"))


def number_comments(comments: DataFrame, order_by: Sequence[str], name: str = "comment_id") -> DataFrame:
    """Surrogate comment id: the row number in an explicit order. Equal rows may share a place."""
    return dense_index(comments, order_by, name=name, spread_ties=True)


def author_labels(posts: DataFrame, comments: DataFrame, label_scope: str = "posts") -> DataFrame:
    """Largest ``active`` of each author's rows: of the posts only, or of posts and comments.

    With 'posts', the graph label, an author who only comments stays 0.
    """
    if label_scope not in ("posts", "all"):
        raise ValueError("label_scope is 'posts' or 'all'")
    of_comments = F.lit(0) if label_scope == "posts" else F.col("active")
    rows = posts.select("author", "active").unionAll(comments.select("author", of_comments.alias("active")))
    active = F.coalesce(F.max(to_number(F.col("active")).cast("int")), F.lit(0))
    return rows.where(F.col("author").isNotNull()).groupBy("author").agg(active.alias("active"))


def _score(rows: DataFrame) -> Column:
    """``to_number`` of the score; a number needs no look at its text."""
    if isinstance(rows.schema["score"].dataType, NumericType):
        return F.coalesce(nan_to_null(F.col("score").cast("double")), F.lit(0.0))
    return to_number(F.col("score"))


def _placed_forum(
    posts: DataFrame, comments: DataFrame, label_scope: str, row_order: str | None, partitions: int | None, edges: bool
) -> tuple[DataFrame, _Placed, _Placed]:
    labels = author_labels(posts, comments, label_scope).select(
        F.col("author").cast("string").alias("key"), F.col("active").alias("y")
    )
    order = ["key"]
    if row_order:
        place = F.col(row_order).cast("bigint")
        behind = F.lit(1 << 62)
        first = (
            posts.select("author", place.alias("p"))
            .unionAll(comments.select("author", (place + behind).alias("p")))
            .where(F.col("author").isNotNull())
            .groupBy(F.col("author").cast("string").alias("key"))
            .agg(F.min("p").alias("place"))
        )
        labels, order = labels.join(first, "key"), ["place", "key"]
    indexed = dense_index(labels, order, partitions=partitions)
    authors = _as_nodes(indexed, "author", F.col("idx").cast("double"))
    wrote = {"author": _probe(posts, "author")} if edges else {}
    said = {"post": strip_post_prefix(F.col("post_id")), "author": _probe(comments, "author")} if edges else {}
    written = _placed(posts, "post", "post_id", _score(posts), None, row_order, partitions, **wrote)
    commented = _placed(comments, "comment", "comment_id", _score(comments), None, None, partitions, **said)
    return authors, written, commented


def forum_nodes(
    posts: DataFrame,
    comments: DataFrame,
    label_scope: str = "posts",
    row_order: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Authors (x = own index, labelled), posts and comments (x = score).

    ``comments`` carries ``comment_id`` (see ``number_comments``). With
    ``row_order``, a row-number column of both tables, authors are indexed by
    first appearance, all posts coming before all comments.
    """
    authors, written, commented = _placed_forum(posts, comments, label_scope, row_order, partitions, False)
    return _union([authors, written.nodes, commented.nodes])


def forum_edges(nodes: DataFrame, written: _Placed, commented: _Placed) -> DataFrame:
    """wrote_post for every post row, wrote_comment for every comment row, has_comment where the post is known."""
    return _union(
        [
            _related(written, "author", nodes, ("author", "wrote_post", "post"), "dst"),
            _related(commented, "author", nodes, ("author", "wrote_comment", "comment"), "dst"),
            _related(commented, "post", nodes, ("post", "has_comment", "comment"), "dst"),
        ]
    )


def forum_graph(
    posts: DataFrame, comments: DataFrame, label_scope: str = "posts", row_order: str | None = None
) -> Graph:
    """The nodes of ``forum_nodes`` and their edges."""
    authors, written, commented = _placed_forum(posts, comments, label_scope, row_order, None, True)
    nodes = _union([authors, written.nodes, commented.nodes])
    edges = materialize(forum_edges(nodes, written, commented), "edges", ["relation"])
    return Graph(Profile(FORUM), nodes, edges)
