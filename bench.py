"""Bench: time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_query_time", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is fully executed (results written to the no-op sink, so every
row is produced but nothing is collected to the driver).  Times are the best
of ``BENCH_REPEAT`` full runs (default 2; run-to-run noise on a shared VM is
large for the iterative ML jobs) after a warm-up of the session.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "conversion_curve",
    "last_day_cart_pairs",
    "last_hour_cart_pairs",
    "training_set",
    "scoring_set",
    "join_full_outer_chain",
    "predict_buyers",
    "hashing_tf",
    "tfidf_hashed",
    "tfidf_job",
    "spam_train_score",
    "auc_roc",
    "spam_grid_search",
    "text_grid_sample",
    "spam_sgd_legacy",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from basketry.plans import registry
    from basketry.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="basketry-bench")
    # Warm-up on the smallest tables: JVM class loading and JIT of the
    # relational, text and ML code paths (a long-running session is warm).
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in ("conversion_curve", "hashing_tf", "predict_buyers"):
        registry.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            df = registry.QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        timings[name] = round(best, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({"metric": "total_query_time", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
