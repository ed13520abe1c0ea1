"""Time the headline queries: ``BENCH_SF_DIR`` (default sf0.1) on ``local[BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from partledger.plans.catalog import BUILDERS
from partledger.plans.workspace import Workspace
from partledger.session import local_session

HEADLINES = [
    "merge_claims",
    "claim_features",
    "match_fuzzy",
    "match_cosine",
    "frequent_itemsets",
    "frequent_itemsets_parts",
    "association_rules",
    "describe_table",
    "stratified_split",
    "repeated_stratified_folds",
    "roc_auc",
    "average_precision",
    "silhouette",
    "svd_fit",
    "recommend_topn",
    "embedding_topk",
    "iforest_score",
    "rf_predict",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = local_session(cpus, partitions=max(8, int(cpus) if cpus.isdigit() else 8))
    spark.sparkContext.setLogLevel("OFF")
    BUILDERS["row_counts"](spark, folder.replace("sf0.1", "sf0.001")).collect()  # start the workers
    times = {}
    for name in names:
        Workspace.forget()  # every query builds all it needs
        start = time.time()
        BUILDERS[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    total = round(sum(times.values()), 3)
    scale = folder.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": scale}))


if __name__ == "__main__":
    main()
