import math

from pyspark.sql import functions as F

from agora.functions import cleaning, scoring
from tests.conftest import rows


def values(df, column):
    return [r[0] for r in df.orderBy("n").select(column).collect()]


def test_numbers_flags_ids_and_prefix(spark):
    df = spark.createDataFrame(
        [(1, "abc", "12.0", "t3_at3_b", True), (2, "2.5", None, "x", None), (3, "nan", "7", "t3_", False), (4, None, "x", None, True), (5, "1d", "-3.9", "a", True)],
        "n int, text string, id string, post string, flag boolean",
    )
    assert values(df, cleaning.to_number(F.col("text"))) == [0.0, 2.5, 0.0, 0.0, 0.0]
    assert values(df, cleaning.to_id(F.col("id"))) == [12, None, 7, None, -3]
    assert values(df, cleaning.strip_post_prefix(F.col("post"))) == ["ab", "x", "", None, "a"]
    assert values(df, cleaning.to_flag(F.col("flag"))) == [True, True, False, True, True]
    assert values(df, cleaning.to_flag(F.col("flag"), missing=False)) == [True, False, False, True, True]


def test_float_ids_truncate_and_nan_is_missing(spark):
    df = spark.createDataFrame([(1, 12.9), (2, float("nan")), (3, None)], "n int, id double")
    assert values(df, cleaning.to_id(F.col("id"))) == [12, None, None]


def test_drop_fill_and_incomplete_rows(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", 2.0, None), (None, 1.0, 1)], "author string, score double, k int")
    assert cleaning.drop_columns(df, ["k", "absent"]).columns == ["author", "score"]
    filled = cleaning.fill_missing(df, {"score": 0})
    assert rows(cleaning.drop_incomplete(filled)) == [("a", 0.0, 1)]


def test_scores(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 1), (2, 800.0, -800.0, 1), (3, -1.0, 2.0, 0)], "n int, z0 double, z1 double, y int")
    p = scoring.positive_probability(F.col("z0"), F.col("z1"))
    assert values(df, scoring.graph_class(p)) == [0, 0, 1]
    assert values(df, scoring.tabular_class(p)) == [1, 0, 1]
    losses = values(df, scoring.cross_entropy(F.col("z0"), F.col("z1"), F.col("y")))
    assert [round(v, 9) for v in losses] == [round(math.log(2), 9), 1600.0, round(math.log1p(math.exp(3)), 9)]
    assert values(df, scoring.relu(F.col("z1"))) == [0.0, 0.0, 2.0]


def test_class_weight_without_positives(spark):
    df = spark.createDataFrame([(0,), (0,)], "y int")
    assert rows(scoring.class_weight_ratio(df, "y")) == [(2, 0, 1.0)]
