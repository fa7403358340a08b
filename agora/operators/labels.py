"""Percentile labels for users and authors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.config import LABEL_QUANTILE
from agora.functions.scoring import influence_score, total_activity
from agora.operators.quantile import exact_quantile
from agora.operators.skew import salted_join
from agora.session import materialize


def label_above(df: DataFrame, score: str, threshold: float | None, name: str) -> DataFrame:
    """1 where the score is strictly greater than the threshold; a missing score gives 0."""
    value = F.col(score)
    above = value > F.lit(threshold).cast("double")
    known = value.isNotNull() & ~F.isnan(value.cast("double"))
    return df.withColumn(name, F.coalesce(known & above, F.lit(False)).cast("int"))


def label_influential(users: DataFrame, q: float = LABEL_QUANTILE) -> DataFrame:
    """Add ``influence_score`` and ``influential``."""
    scored = users.withColumn("influence_score", influence_score())
    return label_above(scored, "influence_score", exact_quantile(scored, "influence_score", q), "influential")


def rows_per_key(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def align_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Outer-align two frames of counts by key; a count missing on one side is 0."""
    counts = [c for c in [*left.columns, *right.columns] if c != key]
    return left.join(right, key, "full").fillna(0, counts)


def label_active(
    posts: DataFrame,
    comments: DataFrame,
    q: float = LABEL_QUANTILE,
    exclude_authors: Sequence[str] = (),
) -> DataFrame:
    """One row per author: post_count, comment_count, total_activity, active.

    ``exclude_authors`` can leave out placeholder names such as those of deleted accounts.
    """
    kept = [df.where(~F.col("author").isin(list(exclude_authors))) for df in (posts, comments)]
    activity = align_counts(
        rows_per_key(kept[0], "author", "post_count"),
        rows_per_key(kept[1], "author", "comment_count"),
        "author",
    ).withColumn("total_activity", total_activity("post_count", "comment_count"))
    activity = materialize(activity, "activity")
    return label_above(activity, "total_activity", exact_quantile(activity, "total_activity", q), "active")


def propagate_label(rows: DataFrame, labels: DataFrame, key: str = "author", label: str = "active") -> DataFrame:
    """Attach the label to every row of its key; rows without one get 0."""
    return salted_join(rows, labels.select(key, label), key, "left").fillna(0, [label]).select(*rows.columns, label)
