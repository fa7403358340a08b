"""Models, training metrics and predictions as Parquet tables."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession

from agora.operators.sage import Parameters
from agora.operators.sage_train import Trained, weights_frame, weights_from
from agora.operators.trees import Search


def save_artifacts(trained: Trained, path: str) -> None:
    """``weights`` and ``train_metrics`` below ``path``."""
    spark = trained.metrics.sparkSession
    weights_frame(spark, trained.parameters).write.parquet(f"{path}/weights", mode="overwrite")
    trained.metrics.write.parquet(f"{path}/train_metrics", mode="overwrite")


def save_predictions(predictions: DataFrame, path: str) -> None:
    predictions.write.parquet(f"{path}/predictions", mode="overwrite")


def load_weights(spark: SparkSession, path: str) -> Parameters:
    return weights_from(spark.read.parquet(f"{path}/weights"))


def save_search(spark: SparkSession, search: Search, path: str) -> None:
    """The best trees as an ML model, and every draw of the search with its score."""
    search.model.write().overwrite().save(f"{path}/model")
    rows = [(n, {k: float(v) for k, v in draw.items()}, float(f1), draw == search.best) for n, (draw, f1) in enumerate(search.scores)]
    frame = spark.createDataFrame(rows, "draw int, parameters map<string, double>, f1 double, best boolean")
    frame.coalesce(1).write.parquet(f"{path}/search", mode="overwrite")


def load_search(spark: SparkSession, path: str) -> Search:
    """The stored search; its model predicts as the one that was stored."""
    rows = spark.read.parquet(f"{path}/search").orderBy("draw").collect()
    scores = [(dict(r["parameters"]), r["f1"]) for r in rows]
    best = next(dict(r["parameters"]) for r in rows if r["best"])
    return Search(GBTClassificationModel.load(f"{path}/model"), best, scores)
