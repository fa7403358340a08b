"""Approximate thresholds from mergeable quantile sketches, as an alternative to the exact quantile.

Each ingest adds a sketch of its own rows; a threshold merges the stored sketches, whose size depends on ``k`` and hardly
on the number of rows. Earlier rows are not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.config import LABEL_QUANTILE
from agora.functions.scoring import influence_score
from agora.operators.labels import label_above

#: Size of a sketch: the rank error is about 0.1 % of the rows with this one, and shrinks in proportion as it grows.
K = 4000


def value_sketch(df: DataFrame, column: str, k: int = K) -> DataFrame:
    """One row: ``sketch`` of the non-missing values, and how many there are. Without any, the sketch is null."""
    value = F.col(column).cast("double")
    known = F.when(value.isNotNull() & ~F.isnan(value), value)
    return df.agg(F.count(known).alias("n"), F.kll_sketch_agg_double(known, F.lit(k)).alias("sketch")).select(
        "n", F.when(F.col("n") > 0, F.col("sketch")).alias("sketch")
    )


def add_sketch(df: DataFrame, column: str, path: str, batch: int | str, k: int = K) -> None:
    """Store the sketch of one ingest below ``path``; an ingest that is run again replaces its own."""
    value_sketch(df, column, k).coalesce(1).write.parquet(f"{path}/batch={batch}", mode="overwrite")


def stored_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("n bigint, sketch binary, batch string").option("basePath", path).parquet(path)


def sketched_quantile(sketches: DataFrame, q: float = LABEL_QUANTILE, k: int = K) -> float | None:
    """The quantile over all stored rows, within the sketches' rank error; None without values."""
    merged = sketches.where(F.col("n") > 0).agg(F.count(F.lit(1)).alias("parts"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    value = F.when(F.col("parts") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q)))
    return merged.select(value.alias("v")).first()["v"]


def label_influential_sketched(users: DataFrame, sketches: DataFrame, q: float = LABEL_QUANTILE) -> DataFrame:
    """``influence_score`` and ``influential`` against the threshold of stored sketches: one pass over the rows."""
    scored = users.withColumn("influence_score", influence_score())
    return label_above(scored, "influence_score", sketched_quantile(sketches, q), "influential")
