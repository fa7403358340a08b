"""Boosted-tree classification of the feature tables with random search."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.config import SEARCH_DRAWS, SEARCH_FOLDS, SEED
from agora.functions.scoring import class_weight_ratio, tabular_class
from agora.operators.ordering import dense_index
from agora.operators.sampling import seeded_hash
from agora.session import materialize


@dataclass
class Search:
    model: GBTClassificationModel
    best: dict[str, float]
    scores: list[tuple[dict[str, float], float]]


def feature_vectors(df: DataFrame, target: str, drop: Sequence[str] = ()) -> DataFrame:
    """``features`` from every column but the target and the identifiers, and ``label``."""
    inputs = [c for c in df.columns if c != target and c not in drop]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error")
    return assembler.transform(df).withColumn("label", F.col(target).cast("double"))


def with_class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Positives weigh negatives / positives, negatives 1."""
    ratio = class_weight_ratio(df, label).select("scale_pos_weight").first()[0]
    return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(float(ratio))).otherwise(1.0))


def boosted_trees(seed: int = SEED) -> GBTClassifier:
    """Boosted trees for log-loss (MLlib's logistic loss)."""
    return GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", seed=seed)


def tree_params(trees: GBTClassifier, draw: dict[str, float]) -> dict:
    """Map a draw to MLlib parameters.

    Two are approximations: the column sample is drawn per node instead of per
    tree, and gamma becomes a minimum information gain, which has other units.
    """
    share = draw["colsample_bytree"]
    return {
        trees.maxIter: int(draw["n_estimators"]),
        trees.maxDepth: int(draw["max_depth"]),
        trees.stepSize: float(draw["learning_rate"]),
        trees.subsamplingRate: float(draw["subsample"]),
        trees.featureSubsetStrategy: "all" if share >= 1 else str(share),
        trees.minInfoGain: float(draw["gamma"]),
    }


def random_draws(grid: dict[str, list], n: int, seed: int = SEED) -> list[dict[str, float]]:
    """``n`` different combinations of the grid, or all if there are fewer."""
    names = sorted(grid)
    total = math.prod(len(grid[name]) for name in names)
    draws = []
    for number in random.Random(seed).sample(range(total), min(n, total)):
        draw = {}
        for name in names:
            number, place = divmod(number, len(grid[name]))
            draw[name] = grid[name][place]
        draws.append(draw)
    return draws


def stratified_folds(df: DataFrame, key: str, label: str, folds: int, seed: int = SEED) -> DataFrame:
    """Fold number such that every class is spread evenly over the folds."""
    hashed = df.withColumn("_order", seeded_hash(seed, key))
    placed = dense_index(hashed, ["_order", key], within=[label], name="_place")
    return placed.withColumn("fold", (F.col("_place") % folds).cast("int")).drop("_order", "_place")


def random_search(
    train: DataFrame,
    key: str,
    target: str,
    drop: Sequence[str],
    grid: dict[str, list],
    draws: int = SEARCH_DRAWS,
    folds: int = SEARCH_FOLDS,
    seed: int = SEED,
    parallelism: int = 4,
) -> Search:
    """Best of some draws by cross-validated F1 of the positive class, refitted on all of ``train``."""
    folded = stratified_folds(train, key, target, folds, seed)
    prepared = with_class_weight(feature_vectors(folded, target, drop=[*drop, "fold", "split"]))
    prepared = materialize(prepared.select("features", "label", "weight", "fold"), "training")
    trees = boosted_trees(seed)
    chosen = random_draws(grid, draws, seed)
    evaluator = MulticlassClassificationEvaluator(
        metricName="fMeasureByLabel", metricLabel=1.0, labelCol="label", predictionCol="prediction"
    )
    validator = CrossValidator(
        estimator=trees,
        estimatorParamMaps=[tree_params(trees, d) for d in chosen],
        evaluator=evaluator,
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=seed,
    )
    fitted = validator.fit(prepared)
    scores = list(zip(chosen, fitted.avgMetrics))
    return Search(fitted.bestModel, max(scores, key=lambda s: s[1])[0], scores)


def predict_trees(model: GBTClassificationModel, df: DataFrame, target: str, drop: Sequence[str] = ()) -> DataFrame:
    """prob, pred and label of every row; identifiers in ``drop`` are carried along."""
    scored = model.transform(feature_vectors(df, target, drop))
    probability = vector_to_array("probability")
    return (
        scored.withColumn("prob", F.get(probability, F.lit(1)))
        .withColumn("pred", tabular_class(F.col("prob")))
        .withColumn("label", F.col("label").cast("int"))
        .select(*[c for c in drop if c in df.columns], "prob", "pred", "label")
    )
