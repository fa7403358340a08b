"""End-to-end runs of both dataset profiles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.catalog import LABEL, QA
from agora.config import GRAPH_SETS, IDENTIFIERS, SAMPLE_ROWS, SEARCH_DRAWS, SEED, TEST_SHARE, GraphSet, tree_set
from agora.functions.cleaning import drop_columns, drop_incomplete, fill_missing
from agora.operators.evaluation import evaluate
from agora.operators.features import forum_features, qa_features
from agora.operators.graph_build import Graph, forum_graph, number_comments, qa_graph
from agora.operators.graph_ops import prepare, validate
from agora.operators.labels import label_active, label_influential, propagate_label
from agora.operators.sage import predict
from agora.operators.sage_train import Trained, train_sage
from agora.operators.sampling import sample_exact, take_first, train_test_split
from agora.operators.trees import Search, predict_trees, random_search
from agora.session import materialize

# Columns that are dropped after loading.
POST_EXTRAS = ["timestamp", "permalink", "title", "selftext"]
COMMENT_EXTRAS = ["timestamp", "body", "permalink"]
USER_EXTRAS = ["reputation", "gold_badges", "silver_badges", "bronze_badges", "influence_score"]
# End of fixed values.


@dataclass
class ForumTables:
    posts: DataFrame
    comments: DataFrame


def qa_users_labelled(users: DataFrame) -> DataFrame:
    return drop_columns(label_influential(users), USER_EXTRAS)


def qa_feature_table(users: DataFrame, questions: DataFrame, answers: DataFrame) -> DataFrame:
    return qa_features(qa_users_labelled(users), questions, answers)


def clean_forum(posts: DataFrame, comments: DataFrame) -> ForumTables:
    """Drop text columns, fill comment scores, drop comments that still miss something."""
    kept = fill_missing(drop_columns(comments, COMMENT_EXTRAS), {"score": 0})
    return ForumTables(drop_columns(posts, POST_EXTRAS), drop_incomplete(kept))


def label_forum(tables: ForumTables, exclude_authors: Sequence[str] = ()) -> ForumTables:
    """Label authors on all rows, then carry the label to every row."""
    labels = label_active(tables.posts, tables.comments, exclude_authors=exclude_authors)
    return ForumTables(propagate_label(tables.posts, labels), propagate_label(tables.comments, labels))


def sample_forum(
    tables: ForumTables,
    n_keep: int = SAMPLE_ROWS,
    random_sample: bool = False,
    post_order: Sequence[str] = ("post_id",),
    comment_order: Sequence[str] = ("comment_id",),
    seed: int = SEED,
) -> ForumTables:
    """Keep ``n_keep`` posts and, independently, ``n_keep`` comments; fewer rows are an error."""
    if random_sample:
        posts = sample_exact(tables.posts, n_keep, post_order, seed)
        comments = sample_exact(tables.comments, n_keep, comment_order, seed)
    else:
        posts = take_first(tables.posts, n_keep, post_order)
        comments = take_first(tables.comments, n_keep, comment_order)
    return ForumTables(posts, comments)


def forum_labelled(posts: DataFrame, comments: DataFrame, n_keep: int | None = SAMPLE_ROWS, **options) -> ForumTables:
    """Clean, label, sample. ``n_keep=None`` keeps every row."""
    labelled = label_forum(clean_forum(posts, comments))
    if n_keep is not None:
        labelled = sample_forum(labelled, n_keep, **options)
    return ForumTables(materialize(labelled.posts, "posts"), materialize(labelled.comments, "comments"))


@dataclass
class TabularRun:
    search: Search
    predictions: DataFrame
    metrics: DataFrame


def tabular_run(
    features: DataFrame,
    profile: str,
    set_index: int = 1,
    draws: int = SEARCH_DRAWS,
    seed: int = SEED,
    grid: dict[str, list] | None = None,
) -> TabularRun:
    """Split, search, refit and evaluate boosted trees on a feature table."""
    target, drop = LABEL[profile], IDENTIFIERS[profile]
    key = drop[0]
    split = materialize(train_test_split(features, key, TEST_SHARE, seed), "features")
    train = split.where(F.col("split") == "train").drop("split")
    test = split.where(F.col("split") == "test").drop("split")
    search = random_search(train, key, target, drop, grid or tree_set(set_index), draws, seed=seed)
    predictions = materialize(predict_trees(search.model, test, target, drop), "predictions")
    metrics = evaluate(predictions).withColumn("loss", 1.0 - F.col("accuracy"))
    return TabularRun(search, predictions, metrics)


@dataclass
class GraphRun:
    graph: Graph
    trained: Trained
    predictions: DataFrame
    metrics: DataFrame


def graph_run(graph: Graph, settings: GraphSet = GRAPH_SETS[1], seed: int = SEED, **training) -> GraphRun:
    """Split, train and evaluate the graph model; ``training`` goes to ``train_sage``."""
    ready = prepare(validate(graph), settings.val_share, settings.test_share, seed)
    trained = train_sage(ready, settings, seed, **training)
    predictions = materialize(predict(ready, trained.parameters, "test"), "predictions")
    metrics = evaluate(predictions).withColumn("loss", predictions.agg(F.avg("loss").alias("loss")).scalar())
    return GraphRun(ready, trained, predictions, metrics)


def build_graph(profile: str, *tables: DataFrame, label_scope: str = "posts", comment_order=None) -> Graph:
    """Graph of a profile from its labelled tables: users, questions, answers, or posts, comments."""
    if profile == QA:
        return qa_graph(*tables)
    posts, comments = tables
    if "comment_id" not in comments.columns:
        comments = materialize(number_comments(comments, comment_order or comments.columns), "comments")
    return forum_graph(posts, comments, label_scope)
