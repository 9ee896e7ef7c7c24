"""Time the headline jobs; prints one JSON line.

BENCH_SF_DIR: data folder (default /root/testdata/sf0.1), BENCH_CPUS: local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

for _name in ("OPENBLAS_NUM_THREADS", "OMP_NUM_THREADS", "MKL_NUM_THREADS"):
    os.environ.setdefault(_name, "1")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickloom.plans.catalog import QUERIES  # noqa: E402
from clickloom.session import build_session  # noqa: E402

HEADLINE = [
    "daily_pair_counters",
    "rolling_features_user_id",
    "build_basis",
    "build_dataset",
    "history_from_events",
    "build_sequences",
    "popular_items",
    "ndcg_pairs",
    "recommend_top_k",
    "implicit_als",
    "truncated_svd",
    "ease",
    "multvae",
    "boosted_tree_ranker",
    "build_feature_layer",
    "feature_mart",
    "duration_quantiles",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.range(1000).groupBy("id").count().write.format("noop").mode("overwrite").save()
    timings = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - start, 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline jobs",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
