import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from agora.operators import features, labels, sketches
from agora.operators.features import correlation_matrix, forum_features, qa_features
from agora.operators.quantile import exact_quantile
from agora.plans import runs
from tests.conftest import rows


@pytest.mark.parametrize("max_values", [3, 50_000])
def test_quantile_is_exact_while_narrowing(spark, max_values):
    rng = random.Random(1)
    data = [rng.randrange(1000) / 7 for _ in range(3000)] + [5.0] * 1500
    df = spark.createDataFrame([(v,) for v in [*data, None, float("nan")]], "v double").repartition(4)
    for q in (0.0, 0.37, 0.9, 1.0):
        assert exact_quantile(df, "v", q, max_values) == pytest.approx(np.quantile(data, q), abs=1e-12)


def test_quantile_of_nothing(spark):
    assert exact_quantile(spark.createDataFrame([(None,)], "v double"), "v", 0.9) is None


def test_label_is_strict_and_missing_scores_get_zero(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 2.5), (4, None), (5, float("nan"))], "id int, s double")
    assert rows(labels.label_above(df, "s", 2.0, "y"), "id", "y") == [(1, 0), (2, 0), (3, 1), (4, 0), (5, 0)]


def test_equal_scores_label_nobody(spark):
    users = spark.createDataFrame([(i, "n", 10, 0, 0, 0) for i in range(5)], runs_schema())
    assert {r.influential for r in labels.label_influential(users).collect()} == {0}


def runs_schema():
    return "user_id bigint, display_name string, reputation bigint, gold_badges bigint, silver_badges bigint, bronze_badges bigint"


def test_null_reputation(spark):
    users = spark.createDataFrame([(1, "a", None, 1, 1, 1), (2, "b", 5, 0, 0, 0), (3, "c", 500, 9, 9, 9)], runs_schema())
    assert rows(runs.qa_users_labelled(users)) == [(1, "a", 0), (2, "b", 0), (3, "c", 1)]


def test_active_label_counts_both_tables_and_skips_null_authors(spark):
    posts = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "author string")
    comments = spark.createDataFrame([("c",)] * 9 + [("a",), (None,)], "author string")
    active = labels.label_active(posts, comments)
    assert rows(active) == [("a", 2, 1, 3, 0), ("b", 1, 0, 1, 0), ("c", 0, 9, 9, 1)]
    carried = labels.propagate_label(posts, active.where("author <> 'b'"))
    assert rows(carried) == sorted([("a", 0), ("a", 0), ("b", 0), (None, 0)], key=repr)
    without = labels.label_active(posts, comments, exclude_authors=["c"])
    assert rows(without, "author", "active") == [("a", 1), ("b", 0)]


def test_qa_features_zero_fill_and_null_users(spark):
    users = spark.createDataFrame([(1, "a", 0), (2, "b", 1)], "user_id bigint, display_name string, influential int")
    questions = spark.createDataFrame([(10, 1), (11, 1), (None, 1), (12, None)], "question_id bigint, user_id bigint")
    answers = spark.createDataFrame([(1, True), (1, None), (1, False), (None, True)], "user_id bigint, is_accepted boolean")
    assert rows(qa_features(users, questions, answers)) == [(1, "a", 0, 2, 2), (2, "b", 1, 0, 0)]
    assert rows(qa_features(users, questions, answers, null_accepted=False)) == [(1, "a", 0, 2, 1), (2, "b", 1, 0, 0)]


def test_forum_features_bad_scores_count_as_zero(spark):
    posts = spark.createDataFrame(
        [("a", "4", 3, 0), ("a", "abc", None, 1), (None, "9", 1, 1)], "author string, score string, num_comments bigint, active int"
    )
    comments = spark.createDataFrame([("b", "2", 1), ("a", None, 0)], "author string, score string, active int")
    assert rows(forum_features(posts, comments)) == [("a", 2.0, 3, 0.0, 1), ("b", 0.0, 0, 2.0, 1)]


def test_correlation_is_pairwise_complete(spark):
    data = [(1.0, 2.0, None), (2.0, 1.0, 5.0), (3.0, None, 7.0), (4.0, 8.0, 1.0), (5.0, 9.0, 4.0)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    found = {(r.a, r.b): r["corr"] for r in correlation_matrix(df, ["a", "b", "c"]).collect()}
    import pandas as pd

    want = pd.DataFrame(data, columns=list("abc")).corr()
    assert len(found) == 9
    for (a, b), value in found.items():
        assert value == pytest.approx(want.loc[a, b])


def test_sampling_guard_and_independent_samples(spark):
    posts = spark.range(50).select(F.col("id").cast("string").alias("post_id"), F.lit("a").alias("author"), F.lit(1.0).alias("score"), F.lit(1).alias("num_comments"))
    comments = spark.range(60).select(F.col("id").alias("comment_id"), F.lit("t3_1").alias("post_id"), F.lit("b").alias("author"), F.lit(1.0).alias("score"))
    kept = runs.forum_labelled(posts, comments, 40, random_sample=True)
    assert (kept.posts.count(), kept.comments.count()) == (40, 40)
    with pytest.raises(ValueError):
        runs.forum_labelled(posts, comments, 55)


def test_sketches_merge_within_their_rank_error(spark, tmp_path):
    """Three ingests; the threshold comes from the stored sketches alone."""
    rng = np.random.default_rng(3)
    parts = [rng.lognormal(size=30_000), rng.normal(8, 1, size=20_000), np.r_[np.full(9_000, 2.5), [np.nan] * 50]]
    path = str(tmp_path / "sketches")
    for k, part in enumerate(parts):
        frame = spark.createDataFrame(pd.DataFrame({"v": part})).repartition(5)
        sketches.add_sketch(frame, "v", path, k)
        if k == 0:
            sketches.add_sketch(frame, "v", path, k)  # an ingest that runs again counts once
        known = np.sort(np.concatenate(parts[: k + 1]))
        known = known[~np.isnan(known)]
        for q in (0.01, 0.5, 0.9, 0.999):
            found = sketches.sketched_quantile(sketches.stored_sketches(spark, path), q)
            low, high = np.searchsorted(known, found, "left"), np.searchsorted(known, found, "right")
            assert low - 0.005 * len(known) <= q * len(known) <= high + 0.005 * len(known)
    empty = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    sketches.add_sketch(empty, "v", path, 3)
    assert sketches.sketched_quantile(sketches.stored_sketches(spark, path), 0.0) <= known[100]
    assert sketches.sketched_quantile(sketches.value_sketch(empty, "v"), 0.5) is None
    sizes = [len(r.sketch) for r in sketches.stored_sketches(spark, path).where("n > 0").collect()]
    assert max(sizes) < 10 * 8 * sketches.K


def test_wide_correlation_is_pairwise_complete(spark):
    rng = np.random.default_rng(4)
    k = 200
    values = rng.normal(size=(700, k)) @ rng.normal(size=(k, k)) + 1e6
    values[rng.random(values.shape) < 0.2] = np.nan
    values[:, 3] = 5.0  # constant
    values[1:, 4] = np.nan  # one value
    values[:, 5] = np.nan
    table = pd.DataFrame(values, columns=[f"c{i}" for i in range(k)])
    frame = spark.createDataFrame(table).repartition(6)
    found = {(r.a, r.b): r["corr"] for r in correlation_matrix(frame, list(table.columns)).collect()}
    assert len(found) == k * k
    want = table.corr()
    for a in table.columns:
        for b in table.columns:
            if a in ("c4", "c5") or b in ("c4", "c5"):
                assert found[a, b] is None
            elif "c3" in (a, b):
                assert math.isnan(found[a, b])
            else:
                assert found[a, b] == pytest.approx(want.loc[a, b], abs=1e-9)


def test_wide_and_narrow_correlation_agree(spark, monkeypatch):
    rows_ = [(1.0, 2, None), (2.0, 1, 5.0), (4.0, None, float("nan")), (None, 7, 2.0), (3.5, 4, 1.0)] * 3
    frame = spark.createDataFrame(rows_, "a double, b int, c double")
    clean = frame.withColumn("c", F.when(~F.isnan("c"), F.col("c")))
    narrow = {(r.a, r.b): r["corr"] for r in correlation_matrix(clean, ["a", "b", "c"]).collect()}
    monkeypatch.setattr(features, "NARROW", 1)
    assert {(r.a, r.b): r["corr"] for r in correlation_matrix(frame, ["a", "b", "c"]).collect()} == pytest.approx(narrow)
    plan = correlation_matrix(frame, ["a", "b", "c"])._jdf.queryExecution().executedPlan().toString()
    assert "corr(" not in plan and "SinglePartition" not in plan
