"""Hyper-parameter sets and dataset settings."""

from __future__ import annotations

from dataclasses import dataclass

from agora.catalog import FORUM, QA


@dataclass(frozen=True)
class GraphSet:
    hidden: int
    learning_rate: float
    weight_decay: float
    classes: int = 2
    epochs: int = 50
    batch_size: int = 64
    fanouts: tuple[int, ...] = (10, 10)
    val_share: float = 0.1
    test_share: float = 0.1


# Graph model sets, tree search grids, tabular profiles, sample size.
GRAPH_SETS = [
    GraphSet(hidden=32, learning_rate=0.01, weight_decay=1e-5),
    GraphSet(hidden=64, learning_rate=0.01, weight_decay=1e-4),
    GraphSet(hidden=64, learning_rate=0.001, weight_decay=1e-4),
]
TREE_SETS = [
    {
        "n_estimators": [50, 100, 200],
        "max_depth": [3, 5, 7],
        "learning_rate": [0.01, 0.05, 0.1],
        "subsample": [0.5, 0.7, 1.0],
        "colsample_bytree": [0.5, 0.7, 1.0],
        "gamma": [0.0, 0.1, 0.2],
    },
    {
        "n_estimators": [100, 200, 300],
        "max_depth": [5, 10, 15],
        "learning_rate": [0.005, 0.02, 0.1],
        "subsample": [0.6, 0.8, 1.0],
        "colsample_bytree": [0.6, 0.8, 1.0],
        "gamma": [0.0, 0.05, 0.15],
    },
]
IDENTIFIERS = {QA: ["user_id", "display_name"], FORUM: ["author"]}
SAMPLE_ROWS = 80_000
SEED = 42
LABEL_QUANTILE = 0.9
SEARCH_DRAWS = 20
SEARCH_FOLDS = 3
TEST_SHARE = 0.2
# End of fixed values.


def tree_set(index: int) -> dict[str, list]:
    """A search grid by number; unknown numbers are an error, not a default."""
    if not 0 <= index < len(TREE_SETS):
        raise ValueError(f"tree set {index} does not exist; choose 0 to {len(TREE_SETS) - 1}")
    return TREE_SETS[index]
