"""Per-user and per-author feature tables, and their correlations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.functions.cleaning import to_flag, to_number
from agora.functions.scoring import row_max
from agora.operators.vectors import SUMS, by_key, sums_batch, whole_sums

NARROW = 12  # columns whose pairs are aggregated one by one
SPREAD = 32  # places that add up a row of the matrices before the last one
MIDDLE_ROWS = 1000
ROUNDING = 1e-13  # share of a sum of squares below which a spread is none


def questions_per_user(questions: DataFrame) -> DataFrame:
    known = questions.where(F.col("user_id").isNotNull())
    return known.groupBy("user_id").agg(F.count("question_id").alias("total_questions"))


def accepted_per_user(answers: DataFrame, null_accepted: bool = True) -> DataFrame:
    known = answers.where(F.col("user_id").isNotNull())
    accepted = to_flag(F.col("is_accepted"), null_accepted).cast("int")
    return known.groupBy("user_id").agg(F.sum(accepted).alias("accepted_answers"))


def join_user_counts(users: DataFrame, *counts: DataFrame) -> DataFrame:
    """Left-join frames of counts to users; users without a count get 0."""
    joined, names = users, []
    for frame in counts:
        joined = joined.join(frame, "user_id", "left")
        names += [c for c in frame.columns if c != "user_id"]
    return joined.fillna(0, names)


def qa_features(users: DataFrame, questions: DataFrame, answers: DataFrame, null_accepted: bool = True) -> DataFrame:
    """One row per user: name, label, questions asked and accepted answers given."""
    labelled = users.select("user_id", "display_name", "influential")
    return join_user_counts(labelled, questions_per_user(questions), accepted_per_user(answers, null_accepted))


def posts_per_author(posts: DataFrame) -> DataFrame:
    known = posts.where(F.col("author").isNotNull())
    return known.groupBy("author").agg(
        F.avg(to_number(F.col("score"))).alias("avg_post_score"),
        F.coalesce(F.sum("num_comments"), F.lit(0)).alias("total_comments"),
        F.max("active").alias("active_posts"),
    )


def comments_per_author(comments: DataFrame) -> DataFrame:
    known = comments.where(F.col("author").isNotNull())
    return known.groupBy("author").agg(
        F.avg(to_number(F.col("score"))).alias("avg_comment_score"),
        F.max("active").alias("active_comments"),
    )


def join_author_aggregates(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Full outer join by author; whatever one side lacks is 0."""
    joined = posts.join(comments, "author", "full")
    return joined.fillna(0, [c for c in joined.columns if c != "author"])


def forum_features(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """One row per author, from posts and comments that carry ``active``."""
    merged = join_author_aggregates(posts_per_author(posts), comments_per_author(comments))
    return merged.select(
        "author",
        "avg_post_score",
        "total_comments",
        "avg_comment_score",
        row_max("active_posts", "active_comments").alias("active"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns in long form, from one pass over the rows.

    Rows that miss either value of a pair are left out of that pair only. A pair
    with fewer than two rows has none, a constant column NaN. Few columns are one
    aggregation; more go through products of matrices.
    """
    if len(columns) > NARROW:
        return _gram_correlation(df, list(columns))
    numbers = [F.col(c).cast("double").alias(c) for c in columns]
    pairs = []
    for i, a in enumerate(columns):
        for b in columns[i:]:
            corr = F.corr(a, b)
            pairs.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), corr.alias("corr")))
            if a != b:
                pairs.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), corr.alias("corr")))
    wide = df.select(*numbers).agg(F.array(*pairs).alias("pairs"))
    return wide.select(F.inline("pairs"))


def _gram_correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Correlations from the products of masked matrices, block by block.

    With z the values (0 where missing) and m the mask, row i of six matrices is
    kept for each column i: m'm, z'm, m'z, (z^2)'m, m'(z^2) and z'z. They are
    added up in each task, then by row of the matrices, spread over ``SPREAD``
    places, then whole. Nothing holds a number for each pair but these rows.
    """
    k = len(columns)
    numbers = [F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)]
    # Values are taken from near their middle, or large ones would swallow the differences.
    few = df.select(*numbers).limit(MIDDLE_ROWS).agg(*[F.avg(F.when(~F.isnan(f"_{i}"), F.col(f"_{i}"))) for i in range(k)]).first()
    middle = np.array([v if v is not None and np.isfinite(v) else 0.0 for v in few])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, 6, k))
        for batch in batches:
            # A missing value arrives as NaN, and NaN is a missing value.
            values = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]) - middle
            mask = ~np.isnan(values)
            z, m = np.where(mask, values, 0.0), mask.astype(np.float64)
            square = z * z
            for place, product in enumerate((m.T @ m, z.T @ m, m.T @ z, square.T @ m, m.T @ square, z.T @ z)):
                total[:, place] += product
        place = TaskContext.get().partitionId() % SPREAD
        yield sums_batch(np.arange(k) * SPREAD + place, np.zeros(k), np.ones(k, dtype=np.int64), total.reshape(k, 6 * k))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dst, slot, n, x in whole_sums(batches, 6 * k):
            yield sums_batch(dst // SPREAD, slot, n, x)

    def correlate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dst, _, _, x in whole_sums(batches, 6 * k):
            for i, (n, a, b, aa, bb, ab) in zip(dst, x.reshape(-1, 6, k)):
                rows = np.maximum(n, 1.0)
                spread_a, spread_b = aa - a * a / rows, bb - b * b / rows
                constant = (spread_a <= ROUNDING * aa) | (spread_b <= ROUNDING * bb)
                with np.errstate(divide="ignore", invalid="ignore"):
                    corr = np.where(constant, np.nan, np.clip((ab - a * b / rows) / np.sqrt(spread_a * spread_b), -1.0, 1.0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([columns[i]] * k), pa.array(columns), pa.array(corr, mask=n < 2)], names=["a", "b", "corr"]
                )

    spread = by_key(df.select(*numbers).mapInArrow(products, SUMS)).mapInArrow(joined, SUMS)
    return by_key(spread).mapInArrow(correlate, "a string, b string, corr double")
