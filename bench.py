"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from agora.plans.queries import QUERIES
from agora.session import build_session

HEADLINE = [
    "qa_feature_table",
    "forum_feature_table",
    "qa_graph_edges",
    "forum_graph_edges",
    "class_balanced_batches",
    "sampled_neighbors",
    "ego_graph_edges",
    "sample_posts",
    "correlation_matrix",
    "sage_forward",
    "roc_auc",
    "evaluate_predictions",
    "boosted_tree_predictions",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session("bench", cpus, **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()
    seconds = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    total = round(sum(seconds.values()), 3)
    line = {"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder)}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
