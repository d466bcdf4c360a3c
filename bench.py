"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brindle.plans import load
from brindle.session import local_session

HEADLINE = [
    "historical_features", "asof_raw_values", "materialize_incremental", "describe_columns", "stratified_split", "encode_target_oof",
    "scale_robust", "outlier_rule_counts", "mutual_information_rank", "roc_auc", "feature_matrix", "decompose_classical", "acf",
    "chunk_fixed", "dense_topk", "similar_to_item", "bm25_topk", "hybrid_search", "thread_checkpoints", "cooccurrence_counts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    queries, _ = load()
    times: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):  # the first run warms the session up and is not counted
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:] or taken), 3)
    print(json.dumps({"metric": "headline_query_seconds_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
