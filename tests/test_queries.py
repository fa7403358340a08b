"""Registered queries against SQL on the smallest tables, and checks of their plans."""

import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
import check_queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUICK = [
    "csv_scan_users", "flatten_user_pages", "stream_question_pages", "truncate_ids", "influence_score",
    "label_active", "propagate_label", "join_user_counts", "forum_feature_table", "correlation_matrix",
    "sample_posts", "number_comments", "class_balanced_batches", "qa_graph_edges", "forum_graph_nodes",
    "sampled_neighbors", "ego_graph_edges", "node_split", "roc_points_reduced", "batch_scores", "sage_forward",
]


@pytest.fixture(scope="module")
def connection():
    return check_queries.duck(FOLDER)


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_sql(spark, connection, name):
    assert check_queries.compare(spark, connection, FOLDER, name).startswith("ok")


def test_every_statement_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 80


def test_entry_is_the_feature_table(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "display_name", "influential", "total_questions", "accepted_answers"]
    assert df.agg(F.count("*"), F.sum("influential")).first()[:2] == (150, 15)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


PLANNED = [
    "qa_feature_table", "forum_feature_table", "qa_graph_nodes", "qa_graph_edges", "number_comments",
    "roc_points", "roc_points_reduced", "sample_posts", "train_test_rows", "class_balanced_batches",
]


@pytest.mark.parametrize("name", PLANNED)
def test_plans_stay_distributed_and_in_the_jvm(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    for forbidden in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct"):
        assert forbidden not in text
    for window in re.findall(r"windowspecdefinition\(([^)]*)", text):
        assert "_part" in window or "_dst" in window, "a window has no partition"
    assert "Exchange SinglePartition" not in text or name in ("roc_points", "roc_points_reduced")


def test_scans_read_only_what_they_need(spark):
    text = plan(entry.queries()["rows_per_author"](spark, FOLDER))
    assert "ReadSchema: struct<l_partkey:bigint>" in text
    text = plan(spark.read.parquet(f"{FOLDER}/orders.parquet").where("o_custkey = 5").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_custkey), EqualTo(o_custkey,5)]" in text
