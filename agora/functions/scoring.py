"""Column expressions for scores, activations and thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weight of each log-scaled term of the influence score.
INFLUENCE_WEIGHTS = {"reputation": 1, "gold_badges": 3, "silver_badges": 2, "bronze_badges": 1}
# End of fixed values.


def influence_score(weights: dict[str, float] = INFLUENCE_WEIGHTS) -> Column:
    terms = [F.lit(float(w)) * F.log1p(F.col(name).cast("double")) for name, w in weights.items()]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def row_max(*columns: str) -> Column:
    return F.greatest(*columns)


def total_activity(post_count: str, comment_count: str) -> Column:
    return F.col(post_count) + F.col(comment_count)


def relu(value: Column) -> Column:
    return F.greatest(value, F.lit(0.0))


def positive_probability(z0: Column, z1: Column) -> Column:
    """Second component of a two-way softmax."""
    return 1.0 / (1.0 + F.exp(z0 - z1))


def cross_entropy(z0: Column, z1: Column, label: Column) -> Column:
    """Two-class cross-entropy from logits, without overflow for large margins."""
    margin = F.when(label == 1, z1 - z0).otherwise(z0 - z1)
    return F.log1p(F.exp(-F.abs(margin))) + F.greatest(-margin, F.lit(0.0))


def tabular_class(probability: Column) -> Column:
    return (probability >= 0.5).cast("int")


def graph_class(probability: Column) -> Column:
    """A tie goes to class 0, as with argmax."""
    return (probability > 0.5).cast("int")


def class_weight_ratio(df: DataFrame, label: str) -> DataFrame:
    """One row: negatives over positives, 1 when there is no positive."""
    counts = df.agg(
        F.count_if(F.col(label) == 0).alias("neg"),
        F.count_if(F.col(label) == 1).alias("pos"),
    )
    ratio = F.when(F.col("pos") > 0, F.try_divide(F.col("neg"), F.col("pos"))).otherwise(F.lit(1.0))
    return counts.select("neg", "pos", ratio.cast("double").alias("scale_pos_weight"))
