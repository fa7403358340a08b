"""Registered queries: every operator over the fixture tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.catalog import FORUM, QA, Profile
from agora.config import GraphSet
from agora.functions import cleaning, scoring
from agora.operators import evaluation, features, graph_build, graph_ops, labels, neighbors, ordering, sage, sampling
from agora.operators import sage_train, sketches, trees
from agora.operators.graph_build import Graph
from agora.operators.quantile import exact_quantile
from agora.plans import fixtures, runs
from agora.plans.closed_form import closed_form_weights
from agora.session import materialize, scratch_path
from agora.sources import artifacts, assets, graph_store, pages, tables
from agora.streaming.ingest import ingest_feeds_stream, ingest_pages_stream, read_feeds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SEED = 42


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Shared inputs -------------------------------------------------------------


def scored_users(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.qa_users(spark, d).withColumn("score", scoring.influence_score())


def labelled_users(spark: SparkSession, d: str) -> DataFrame:
    return runs.qa_users_labelled(fixtures.qa_users(spark, d))


def raw_forum(spark: SparkSession, d: str) -> runs.ForumTables:
    return runs.ForumTables(fixtures.forum_posts(spark, d), fixtures.forum_comments(spark, d))


def labelled_forum(spark: SparkSession, d: str) -> runs.ForumTables:
    raw = raw_forum(spark, d)
    return runs.forum_labelled(raw.posts, raw.comments, None)


def qa_graph_of(spark: SparkSession, d: str) -> Graph:
    users = materialize(fixtures.qa_users(spark, d), "users")
    questions = materialize(fixtures.qa_questions(spark, d), "questions")
    return graph_build.qa_graph(runs.qa_users_labelled(users), questions, fixtures.qa_answers(spark, d))


def forum_graph_of(spark: SparkSession, d: str) -> Graph:
    labelled = labelled_forum(spark, d)
    return graph_build.forum_graph(labelled.posts, labelled.comments)


def flat_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.select("node_type", "key", "idx", F.get("x", F.lit(0)).alias("x"), "y")


# Sources and sinks ---------------------------------------------------------


@query
def csv_scan_users(spark, d):
    """Users written as CSV with missing-value spellings, then read under a schema."""
    token = F.when(F.col("user_id") % 10 == 0, "NA").when(F.col("user_id") % 10 == 1, "None")
    users = fixtures.qa_users(spark, d).withColumn("reputation", F.coalesce(token, F.col("reputation").cast("string")))
    path = scratch_path(spark, "users-csv")
    tables.write_table(users, path, "csv")
    columns = ", ".join(
        f"{c} string" if c == "display_name" else f"{c} bigint" for c in users.columns
    )
    return tables.read_table(spark, path, columns, multi_line=False)


@query
def csv_inferred_types(spark, d):
    """Users with a boolean, a decimal, and missing-value spellings, written as CSV and read without a schema."""
    users = fixtures.qa_users(spark, d)
    token = F.when(F.col("user_id") % 10 == 0, "NA").when(F.col("user_id") % 10 == 1, "None")
    users = users.withColumn("reputation", F.coalesce(token, F.col("reputation").cast("string")))
    half = F.when(F.col("user_id") % 4 != 0, F.col("gold_badges") / 2).alias("half")
    text = users.select("*", half, (F.col("user_id") % 2 == 0).alias("even"), F.concat(F.lit('say "'), "user_id", F.lit('", twice')).alias("quoted"))
    path = scratch_path(spark, "users-csv")
    tables.write_table(text, path, "csv")
    return tables.read_table(spark, path)


@query
def table_round_trip(spark, d):
    """Feature table written as Parquet by the sink and read back."""
    path = scratch_path(spark, "features")
    tables.write_table(qa_feature_table(spark, d), path)
    return spark.read.parquet(path)


def _landed_pages(spark: SparkSession, items: DataFrame, size: int, key: str) -> str:
    """Items dealt to pages of a fixed size and landed as one JSON document for each page."""
    path = scratch_path(spark, "pages")
    numbered = ordering.dense_index(items.select(key, "item"), [key], spread_ties=True)
    document = F.to_json(F.struct(F.collect_list("item").alias("items"), F.lit(False).alias("has_more")))
    paged = numbered.groupBy(F.floor(F.col("idx") / size)).agg(document.alias("value"))
    paged.select("value").write.text(path)
    return path


def _user_pages(spark, d) -> str:
    badges = F.struct(
        F.col("gold_badges").alias("gold"), F.col("silver_badges").alias("silver"), F.col("bronze_badges").alias("bronze")
    )
    item = F.struct("user_id", "display_name", "reputation", F.when(F.col("user_id") % 7 != 0, badges).alias("badge_counts"))
    return _landed_pages(spark, fixtures.qa_users(spark, d).select("user_id", item.alias("item")), 100, "user_id")


def _question_items(spark, d) -> DataFrame:
    owner = F.struct(
        "user_id",
        F.concat(F.lit("name "), F.col("user_id").cast("string")).alias("display_name"),
        F.when(F.col("question_id") % 3 == 0, F.col("user_id") + 1).alias("reputation"),
    )
    item = F.struct(
        "question_id",
        F.array(F.lit("spark"), F.lit("sql")).alias("tags"),
        "score",
        "accepted_answer_id",
        F.when(F.col("question_id") % 5 != 0, owner).alias("owner"),
    )
    return fixtures.qa_questions(spark, d).select("question_id", item.alias("item"))


def _question_pages(spark, d) -> str:
    return _landed_pages(spark, _question_items(spark, d), 100, "question_id")


def _answer_pages(spark, d) -> str:
    owner = F.struct("user_id", F.lit("someone").alias("display_name"), F.lit(None).cast("bigint").alias("reputation"))
    item = F.struct(
        "answer_id", "question_id", "is_accepted", "score", F.when(F.col("score") > -20, owner).alias("owner")
    )
    rows = fixtures.qa_answers(spark, d).select("answer_id", item.alias("item"))
    return _landed_pages(spark, rows, 100, "answer_id")


@query
def flatten_user_pages(spark, d):
    return pages.flatten_users(pages.read_pages(spark, _user_pages(spark, d), "users"))


@query
def flatten_question_pages(spark, d):
    flat = pages.flatten_questions(pages.read_pages(spark, _question_pages(spark, d), "questions"))
    return flat.withColumn("tags", F.array_join("tags", ","))


@query
def flatten_answer_pages(spark, d):
    return pages.flatten_answers(pages.read_pages(spark, _answer_pages(spark, d), "answers"))


@query
def stream_question_pages(spark, d):
    """The same pages taken in by the stream."""
    landing, out = _question_pages(spark, d), scratch_path(spark, "ingested")
    ingest_pages_stream(spark, landing, out, scratch_path(spark, "offsets"), "questions").awaitTermination()
    return spark.read.parquet(out).withColumn("tags", F.array_join("tags", ","))


def _land_feeds(spark, items: DataFrame, key: str, path: str) -> DataFrame:
    """Pages of three feeds with numbers and an end marker on each feed's last page."""
    feed = F.concat(F.lit("feed "), (F.col(key) % 3).cast("string")).alias("feed")
    numbered = ordering.dense_index(items.select(feed, key, "item"), ["feed", key], spread_ties=True)
    starts = numbered.groupBy("feed").agg(F.min("idx").alias("start"), F.max("idx").alias("last"))
    # One row for each of the three feeds.
    page = F.expr("(idx - start) div 100").alias("page")
    placed = numbered.join(F.broadcast(starts), "feed").select("feed", page, F.expr("(last - start) div 100").alias("last_page"), "item")
    paged = placed.groupBy("feed", "page", "last_page").agg(F.collect_list("item").alias("items"))
    return materialize(paged.select("feed", "page", "items", (F.col("page") < F.col("last_page")).alias("has_more")), "feed-pages")


@query
def stream_feed_pages(spark, d):
    """Feeds that land out of order, in part twice, and with pages behind their end, taken in by two runs of the stream."""
    landing, out, offsets = (scratch_path(spark, x) for x in ("landing", "feeds", "offsets"))
    paged = _land_feeds(spark, _question_items(spark, d), "question_id", landing)
    document = F.to_json(F.struct("feed", "page", "items", "has_more")).alias("value")
    # First the odd pages and each third one; then all of them, and old items on pages behind the ends.
    paged.where("page % 2 = 1 or page % 3 = 0").select(document).write.text(f"{landing}/first")
    ingest_feeds_stream(spark, f"{landing}/*", out, offsets, "questions").awaitTermination()
    paged.select(document).write.text(f"{landing}/second")
    changed = F.transform("items", lambda i: i.withField("score", F.lit(-1.0)))
    beyond = paged.withColumn("page", F.col("page") + 1_000_000).withColumn("items", changed).withColumn("has_more", F.lit(True))
    beyond.select(document).write.text(f"{landing}/third")
    ingest_feeds_stream(spark, f"{landing}/*", out, offsets, "questions").awaitTermination()
    return read_feeds(spark, out, "questions").withColumn("tags", F.array_join("tags", ","))


@query
def discover_table_files(spark, d):
    return assets.asset_targets(assets.discover_assets(spark, d, ".parquet")).select("name", "copies")


@query
def graph_store_pruned_read(spark, d):
    """Graph written and read back with only one relation."""
    path = scratch_path(spark, "graph")
    graph_store.write_graph(qa_graph_of(spark, d), path)
    return graph_store.read_graph(spark, path, QA, ["user"], ["asks"]).edges


# Cleaning and projection ---------------------------------------------------


@query
def drop_columns(spark, d):
    return cleaning.drop_columns(fixtures.qa_users(spark, d), [*runs.USER_EXTRAS, "not_there"])


@query
def fill_missing(spark, d):
    users = fixtures.qa_users(spark, d)
    holes = users.select("user_id", F.when(F.col("gold_badges") != 1, F.col("gold_badges")).alias("gold_badges"))
    return cleaning.fill_missing(holes, {"gold_badges": 0})


@query
def drop_incomplete(spark, d):
    questions = fixtures.qa_questions(spark, d).select("question_id", "user_id", "accepted_answer_id")
    return cleaning.drop_incomplete(questions)


@query
def coerce_numbers(spark, d):
    text = F.when(F.col("user_id") % 3 == 0, "abc").when(F.col("user_id") % 3 == 1, F.col("reputation").cast("string"))
    return fixtures.qa_users(spark, d).select("user_id", cleaning.to_number(text).alias("value"))


@query
def coerce_flags(spark, d):
    flag = F.when(F.col("score") > -20, F.col("is_accepted"))
    return fixtures.qa_answers(spark, d).select("answer_id", cleaning.to_flag(flag).alias("is_accepted"))


@query
def strip_post_prefix(spark, d):
    posts = fixtures.forum_comments(spark, d)
    return posts.select("comment_id", cleaning.strip_post_prefix(F.col("post_id")).alias("post_id"))


@query
def truncate_ids(spark, d):
    number = F.when(F.col("question_id") % 4 != 0, F.col("question_id").cast("double") + 0.5)
    ids = fixtures.qa_questions(spark, d).select("question_id", cleaning.to_id(number).alias("whole"))
    return ids.where(F.col("whole").isNotNull())


@query
def feature_target_projection(spark, d):
    rows = trees.feature_vectors(qa_feature_table(spark, d), "influential", ["user_id", "display_name"])
    values = F.transform(trees.vector_to_array("features"), lambda v: v.cast("bigint").cast("string"))
    return rows.select("user_id", F.array_join(values, ",").alias("x"), F.col("label").cast("int").alias("y"))


@query
def probability_thresholds(spark, d):
    p = F.col("prob")
    rows = fixtures.predictions(spark, d)
    return rows.select("key", scoring.tabular_class(p).alias("tabular"), scoring.graph_class(p).alias("graph"))


# Scalar functions ----------------------------------------------------------


@query
def influence_score(spark, d):
    return scored_users(spark, d).select("user_id", F.round("score", 6).alias("influence_score"))


@query
def row_max(spark, d):
    users = fixtures.qa_users(spark, d)
    return users.select("user_id", scoring.row_max("gold_badges", "silver_badges").alias("largest"))


@query
def activity_sum(spark, d):
    users = fixtures.qa_users(spark, d)
    return users.select("user_id", scoring.total_activity("gold_badges", "bronze_badges").alias("total_activity"))


@query
def relu(spark, d):
    return fixtures.qa_answers(spark, d).select("answer_id", scoring.relu(F.col("score")).alias("score"))


@query
def softmax_probability(spark, d):
    p = scoring.positive_probability(F.col("z0"), F.col("z1"))
    return fixtures.predictions(spark, d).select("key", F.round(p, 6).alias("prob"))


@query
def class_weight_ratio(spark, d):
    ratio = scoring.class_weight_ratio(fixtures.predictions(spark, d), "label")
    return ratio.withColumn("scale_pos_weight", F.round("scale_pos_weight", 6))


# Labels --------------------------------------------------------------------


@query
def label_influential(spark, d):
    return labelled_users(spark, d)


@query
def label_active(spark, d):
    raw = raw_forum(spark, d)
    return labels.label_active(raw.posts, raw.comments)


@query
def propagate_label(spark, d):
    raw = raw_forum(spark, d)
    active = labels.label_active(raw.posts, raw.comments)
    return labels.propagate_label(raw.comments, active).select("comment_id", "author", "active")


@query
def author_labels_from_posts(spark, d):
    labelled = labelled_forum(spark, d)
    return graph_build.author_labels(labelled.posts, labelled.comments)


@query
def author_labels_from_all(spark, d):
    labelled = labelled_forum(spark, d)
    return graph_build.author_labels(labelled.posts, labelled.comments, "all")


# Joins ---------------------------------------------------------------------


@query
def join_user_counts(spark, d):
    asked = features.questions_per_user(fixtures.qa_questions(spark, d))
    accepted = features.accepted_per_user(fixtures.qa_answers(spark, d))
    return features.join_user_counts(fixtures.qa_users(spark, d).select("user_id"), asked, accepted)


@query
def outer_join_author_aggregates(spark, d):
    labelled = labelled_forum(spark, d)
    return features.join_author_aggregates(
        features.posts_per_author(labelled.posts), features.comments_per_author(labelled.comments)
    )


@query
def align_activity_counts(spark, d):
    raw = raw_forum(spark, d)
    posts = labels.rows_per_key(raw.posts, "author", "post_count")
    return labels.align_counts(posts, labels.rows_per_key(raw.comments, "author", "comment_count"), "author")


@query
def lookup_answer_edges(spark, d):
    """Key-probe join of one relation; answers by unknown users are dropped."""
    answers = fixtures.qa_answers(spark, d)
    nodes = graph_build.qa_nodes(labelled_users(spark, d), fixtures.qa_questions(spark, d), answers)
    return graph_build.lookup_edges(answers, nodes, ("user", "answers", "answer"), "user_id", "answer_id")


@query
def induced_subgraph(spark, d):
    graph = qa_graph_of(spark, d)
    return graph_ops.induced_edges(graph.edges, graph.nodes.where(F.col("idx") % 3 != 0))


# Aggregations --------------------------------------------------------------


@query
def questions_per_user(spark, d):
    return features.questions_per_user(fixtures.qa_questions(spark, d))


@query
def accepted_per_user(spark, d):
    return features.accepted_per_user(fixtures.qa_answers(spark, d))


@query
def posts_per_author(spark, d):
    return features.posts_per_author(labelled_forum(spark, d).posts)


@query
def comments_per_author(spark, d):
    return features.comments_per_author(labelled_forum(spark, d).comments)


@query
def rows_per_author(spark, d):
    return labels.rows_per_key(fixtures.forum_comments(spark, d), "author", "comment_count")


@query
def forum_feature_table(spark, d):
    labelled = labelled_forum(spark, d)
    return features.forum_features(labelled.posts, labelled.comments)


@query
def qa_feature_table(spark, d):
    return runs.qa_feature_table(
        fixtures.qa_users(spark, d), fixtures.qa_questions(spark, d), fixtures.qa_answers(spark, d)
    )


@query
def influence_quantile(spark, d):
    users = scored_users(spark, d)
    return users.agg(
        F.count("score").alias("users"), F.lit(round(exact_quantile(users, "score", 0.9), 6)).alias("threshold")
    )


@query
def sketched_threshold(spark, d):
    """Sketches of ten ingests, merged: whether the threshold lies within one percent of its rank, and the label's share."""
    users, path = scored_users(spark, d), scratch_path(spark, "sketches")
    for part in range(10):
        sketches.add_sketch(users.where(F.col("user_id") % 10 == part), "score", path, part)
    stored = sketches.stored_sketches(spark, path)
    labelled = sketches.label_influential_sketched(fixtures.qa_users(spark, d), stored)
    share = F.avg("influential")
    return labelled.agg(F.count(F.lit(1)).alias("n"), (F.abs(share - 0.1) <= 0.01).alias("close_by"))


WIDE_COLUMNS = 40


@query
def wide_correlation(spark, d):
    """Forty columns with missing values from one pass of masked matrices."""
    users = fixtures.qa_users(spark, d)
    columns = []
    for i in range(WIDE_COLUMNS):
        value = (F.col("user_id") * (i + 3)) % 101 + F.col("gold_badges") * (i % 5)
        columns.append(F.when((F.col("user_id") + i) % 7 != 0, value).cast("double").alias(f"c{i}"))
    found = features.correlation_matrix(users.select(*columns), [f"c{i}" for i in range(WIDE_COLUMNS)])
    return found.select("a", "b", F.round("corr", 6).alias("corr"))


@query
def correlation_matrix(spark, d):
    users = fixtures.qa_users(spark, d)
    # A hole in one column leaves the row out of that column's pairs only.
    holes = users.withColumn("gold_badges", F.when(F.col("user_id") % 5 != 0, F.col("gold_badges")))
    matrix = features.correlation_matrix(holes, ["reputation", "gold_badges", "silver_badges", "bronze_badges"])
    return matrix.withColumn("corr", F.round("corr", 6))


# Samples and sets ----------------------------------------------------------


def _keep(spark: SparkSession, d: str, name: str) -> int:
    """Two thirds of a table's rows."""
    return fixtures.table(spark, d, name).count() * 2 // 3


@query
def first_posts(spark, d):
    return sampling.take_first(fixtures.forum_posts(spark, d), _keep(spark, d, "orders"), ["author", "post_id"])


@query
def sample_posts(spark, d):
    return sampling.sample_exact(fixtures.forum_posts(spark, d), _keep(spark, d, "orders"), "post_id", SEED)


@query
def all_authors(spark, d):
    raw = raw_forum(spark, d)
    return graph_build.all_authors(raw.posts, raw.comments)


@query
def distinct_posts(spark, d):
    """Comments taken as rows of their post: of a repeated id the last row wins."""
    rows = fixtures.forum_comments(spark, d).withColumn("pos", F.col("comment_id"))
    return graph_build.distinct_posts(rows, "pos")


@query
def ego_seed_nodes(spark, d):
    return flat_nodes(sampling.pick_seeds(qa_graph_of(spark, d).nodes, "user", count=5, seed=SEED))


@query
def ego_seed_by_index(spark, d):
    return flat_nodes(sampling.pick_seeds(qa_graph_of(spark, d).nodes, "user", idx=7))


# Positions and batches -----------------------------------------------------


@query
def dense_user_index(spark, d):
    return ordering.dense_index(fixtures.qa_users(spark, d).select("user_id", "display_name"), ["display_name", "user_id"])


@query
def number_comments(spark, d):
    comments = fixtures.forum_comments(spark, d).select("post_id", "author", "score")
    return graph_build.number_comments(comments, ["post_id", "author", "score"])


@query
def sampled_neighbors(spark, d):
    """Two hops around every tenth influential user, three neighbours for each relation."""
    graph = graph_ops.prepare(qa_graph_of(spark, d))
    users = graph.nodes.where((F.col("node_type") == "user") & (F.col("y") == 1))
    seeds = users.select((F.col("idx") % 4).cast("int").alias("batch_id"), "node_type", "idx")
    _, taken = neighbors.neighbor_sample(graph.edges, seeds, (3, 2), SEED)
    return taken


@query
def class_balanced_batches(spark, d):
    users = labelled_users(spark, d).select("user_id", "influential")
    return neighbors.stratified_batches(users, "user_id", "influential", 8, SEED)


# Graph ---------------------------------------------------------------------


@query
def qa_graph_nodes(spark, d):
    return flat_nodes(qa_graph_of(spark, d).nodes)


@query
def qa_graph_edges(spark, d):
    return qa_graph_of(spark, d).edges


@query
def forum_graph_nodes(spark, d):
    return flat_nodes(forum_graph_of(spark, d).nodes)


@query
def forum_graph_edges(spark, d):
    return forum_graph_of(spark, d).edges


@query
def qa_reverse_edges(spark, d):
    return graph_ops.reverse_edges(qa_graph_of(spark, d).edges, Profile(QA))


@query
def forum_reverse_edges(spark, d):
    return graph_ops.reverse_edges(forum_graph_of(spark, d).edges, Profile(FORUM))


@query
def target_self_loops(spark, d):
    return graph_ops.self_loops(qa_graph_of(spark, d).nodes, "user")


@query
def node_split(spark, d):
    nodes = sampling.node_split(qa_graph_of(spark, d).nodes, "user", seed=SEED)
    return nodes.select("node_type", "key", "split")


@query
def relation_degrees(spark, d):
    return graph_ops.degree_summary(qa_graph_of(spark, d).edges)


@query
def multigraph_items(spark, d):
    return graph_ops.multigraph_view(qa_graph_of(spark, d))


@query
def relation_catalogue(spark, d):
    return graph_ops.catalogue_check(graph_ops.prepare(qa_graph_of(spark, d)).edges, Profile(QA))


def _egos(spark, d):
    graph = qa_graph_of(spark, d)
    every = graph.nodes.where((F.col("node_type") == "user") & (F.col("idx") % 10 == 7))
    return graph_ops.ego_graph(graph.edges, every.select(F.col("idx").alias("seed_id"), "node_type", "idx"), 3)


@query
def ego_graph_nodes(spark, d):
    return _egos(spark, d)[0]


@query
def ego_graph_edges(spark, d):
    return _egos(spark, d)[1]


@query
def ego_sizes_of_all_users(spark, d):
    """Every user is a seed: how many nodes lie at each distance, up to two hops."""
    graph = qa_graph_of(spark, d)
    users = graph.nodes.where(F.col("node_type") == "user").select(F.col("idx").alias("seed_id"), "node_type", "idx")
    return graph_ops.ego_nodes(graph.edges, users, 2).groupBy("seed_id", "hops").agg(F.count(F.lit(1)).alias("nodes"))


def _stored(spark, d) -> graph_store.StoredGraph:
    path = scratch_path(spark, "stored")
    name = "graph_" + path[-32:]
    graph_store.write_bucketed(graph_ops.prepare(qa_graph_of(spark, d)), path, name, 8)
    return graph_store.open_bucketed(spark, path, name, QA)


@query
def stored_graph_hop(spark, d):
    """Two hops from every tenth user over the bucketed out-edges of a stored graph with reverses and loops."""
    stored = _stored(spark, d)
    users = stored.nodes.frame.where("node_type = 'user' and idx % 10 = 7")
    return graph_ops.ego_nodes(stored.out_edges, users.select(F.col("idx").alias("seed_id"), "node_type", "idx"), 2)


# Models --------------------------------------------------------------------


@query
def train_test_rows(spark, d):
    users = labelled_users(spark, d)
    return sampling.train_test_split(users, "user_id", 0.2, SEED).select("user_id", "split")


def _split_features(spark, d):
    split = sampling.train_test_split(qa_feature_table(spark, d), "user_id", 0.2, SEED)
    split = materialize(split, "features")
    parts = [split.where(F.col("split") == part).drop("split") for part in ("train", "test")]
    return parts


SMALL_GRID = {
    "n_estimators": [3, 5],
    "max_depth": [2, 3],
    "learning_rate": [0.1],
    "subsample": [1.0],
    "colsample_bytree": [0.7, 1.0],
    "gamma": [0.0],
}
IDS = ["user_id", "display_name"]


@query
def boosted_tree_predictions(spark, d):
    train, test = _split_features(spark, d)
    rows = trees.with_class_weight(trees.feature_vectors(train, "influential", IDS))
    model = trees.boosted_trees().setMaxIter(5).setMaxDepth(3).fit(rows.select("features", "label", "weight"))
    return trees.predict_trees(model, test, "influential", IDS)


@query
def stored_tree_predictions(spark, d):
    """Trees of a search that were stored and read again, on the test rows."""
    train, test = _split_features(spark, d)
    search = trees.random_search(train, "user_id", "influential", IDS, SMALL_GRID, draws=1, folds=3)
    path = scratch_path(spark, "trees")
    artifacts.save_search(spark, search, path)
    return trees.predict_trees(artifacts.load_search(spark, path).model, test, "influential", IDS)


@query
def random_search_scores(spark, d):
    """Cross-validated F1 of two draws."""
    train, _ = _split_features(spark, d)
    search = trees.random_search(train, "user_id", "influential", IDS, SMALL_GRID, draws=2, folds=3)
    rows = [(*[float(draw[name]) for name in sorted(draw)], float(f1)) for draw, f1 in search.scores]
    return spark.createDataFrame(rows, [*sorted(SMALL_GRID), "f1"])


def _prepared(spark, d) -> Graph:
    return graph_ops.prepare(qa_graph_of(spark, d), seed=SEED)


def _scaled(graph: Graph) -> Graph:
    """Question scores are prices; divide them so that the closed-form logits stay moderate."""
    x = F.when(F.col("node_type") == "question", F.transform("x", lambda v: v / 1000)).otherwise(F.col("x"))
    return graph.with_nodes(graph.nodes.withColumn("x", x))


@query
def sage_forward(spark, d):
    """Both layers and the head over all neighbours with closed-form weights of width 2."""
    logits = sage.forward(_scaled(_prepared(spark, d)), closed_form_weights(Profile(QA)))
    return logits.select("idx", F.round("z0", 6).alias("z0"), F.round("z1", 6).alias("z1"))


@query
def sage_test_predictions(spark, d):
    scored = sage.predict(_scaled(_prepared(spark, d)), closed_form_weights(Profile(QA)), "test")
    return scored.select("key", F.round("prob", 6).alias("prob"), "pred", "label", F.round("loss", 6).alias("loss"))


@query
def sage_forward_wide(spark, d):
    """The same at the largest width of the parameter sets, 64."""
    logits = sage.forward(_scaled(_prepared(spark, d)), closed_form_weights(Profile(QA), 64))
    return logits.select("idx", F.round("z0", 4).alias("z0"), F.round("z1", 4).alias("z1"))


TINY = GraphSet(hidden=4, learning_rate=0.01, weight_decay=1e-4, epochs=2, batch_size=16, fanouts=(5, 5))


@query
def sage_training_metrics(spark, d):
    return sage_train.train_sage(_scaled(_prepared(spark, d)), TINY, batches_per_step=4).metrics


@query
def sage_resumed_training(spark, d):
    """Training that stops after the first epoch and is taken up from its stored state."""
    graph, path = _scaled(_prepared(spark, d)), scratch_path(spark, "training")
    sage_train.train_sage(graph, replace(TINY, epochs=1), batches_per_step=4, state_path=path)
    return sage_train.train_sage(graph, TINY, batches_per_step=4, state_path=path).metrics


@query
def sage_sampled_predictions(spark, d):
    graph = _scaled(_prepared(spark, d))
    return sage_train.predict_sampled(graph, closed_form_weights(Profile(QA)), TINY, "test", SEED)


@query
def model_artifacts(spark, d):
    """Weights and metrics stored after one epoch; the stored weights score the test nodes."""
    graph = _scaled(_prepared(spark, d))
    once = GraphSet(hidden=4, learning_rate=0.01, weight_decay=1e-4, epochs=1, batch_size=16, fanouts=(5, 5))
    path = scratch_path(spark, "artifacts")
    artifacts.save_artifacts(sage_train.train_sage(graph, once, batches_per_step=4), path)
    artifacts.save_predictions(sage.predict(graph, artifacts.load_weights(spark, path), "test"), path)
    return spark.read.parquet(f"{path}/predictions").select("key", "prob", "pred", "label")


@query
def qa_tabular_run(spark, d):
    return runs.tabular_run(qa_feature_table(spark, d), QA, draws=1, grid=SMALL_GRID).metrics


@query
def forum_tabular_run(spark, d):
    return runs.tabular_run(forum_feature_table(spark, d), FORUM, draws=1, grid=SMALL_GRID).metrics


@query
def qa_graph_run(spark, d):
    return runs.graph_run(_scaled(qa_graph_of(spark, d)), TINY, batches_per_step=4).metrics


@query
def forum_graph_run(spark, d):
    graph = forum_graph_of(spark, d)
    scaled = graph.with_nodes(graph.nodes.withColumn("x", F.transform("x", lambda v: v / 1000)))
    return runs.graph_run(scaled, TINY, batches_per_step=4).metrics


# Evaluation ----------------------------------------------------------------


@query
def confusion_matrix(spark, d):
    return evaluation.confusion_matrix(fixtures.predictions(spark, d))


@query
def macro_scores(spark, d):
    scores = evaluation.macro_scores(fixtures.predictions(spark, d))
    return scores.select(*[F.round(c, 6).alias(c) for c in ("recall", "precision", "f1_score", "accuracy")])


@query
def accuracy_and_loss(spark, d):
    rates = evaluation.accuracy(fixtures.predictions(spark, d))
    return rates.select(*[F.round(c, 6).alias(c) for c in ("accuracy", "loss")])


@query
def roc_auc(spark, d):
    return evaluation.roc_auc(fixtures.predictions(spark, d)).select(F.round("auc", 6).alias("auc"))


def _curve(spark, d, drop: bool):
    curve = evaluation.roc_curve(fixtures.predictions(spark, d), drop_intermediate=drop)
    finite = F.when(F.col("threshold") < float("inf"), F.col("threshold"))
    return curve.select(
        F.round(finite, 6).alias("threshold"), F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr")
    )


@query
def roc_points(spark, d):
    return _curve(spark, d, False)


@query
def roc_points_reduced(spark, d):
    return _curve(spark, d, True)


@query
def mean_cross_entropy(spark, d):
    return evaluation.mean_cross_entropy(fixtures.predictions(spark, d)).select(F.round("loss", 6).alias("loss"))


METRICS = ("loss", "accuracy", "auc", "precision")


@query
def batch_scores(spark, d):
    scores = evaluation.batch_scores(fixtures.predictions(spark, d), ["epoch", "batch_id"])
    return scores.select("epoch", "batch_id", *[F.round(c, 6).alias(c) for c in METRICS])


@query
def epoch_summary(spark, d):
    scores = evaluation.batch_scores(fixtures.predictions(spark, d), ["epoch", "batch_id"])
    return evaluation.epoch_summary(scores).select("epoch", *[F.round(c, 6).alias(c) for c in METRICS])


@query
def evaluate_predictions(spark, d):
    scores = evaluation.evaluate(fixtures.predictions(spark, d))
    return scores.select(*[F.round(c, 6).alias(c) for c in ("recall", "precision", "f1_score", "accuracy", "auc")])
