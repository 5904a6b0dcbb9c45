"""Wall clock and shuffle bytes per query, from Spark's event log.

Usage: python tools/shuffle_report.py [sf_dir] [query ...]
Runs each query to the noop sink under its own job group with the event log
written to a fresh scratch folder, then sums the tasks' shuffle-write bytes
and records per job group.  Prints a Markdown table.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

DEFAULT = ["conversion_curve", "training_set", "scoring_set", "join_full_outer_chain", "last_day_cart_pairs", "predict_buyers", "hashing_tf", "tfidf_hashed"]


def parse(log_dir: str) -> dict:
    stage_group: dict[int, str] = {}
    out = defaultdict(lambda: {"shuffle_write": 0, "shuffle_records": 0, "tasks": 0})
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for path in sorted(paths):
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        if group:
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    metrics = ev.get("Task Metrics") or {}
                    if group:
                        sw = metrics.get("Shuffle Write Metrics") or {}
                        out[group]["shuffle_write"] += sw.get("Shuffle Bytes Written", 0)
                        out[group]["shuffle_records"] += sw.get("Shuffle Records Written", 0)
                        out[group]["tasks"] += 1
    return out


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")] or DEFAULT
    log_dir = tempfile.mkdtemp(prefix="basketry-eventlog-")
    from pyspark.sql import SparkSession

    from basketry.plans import registry
    from basketry.session import local_session

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{log_dir}")
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .getOrCreate()
    )
    local_session(8, 16)  # same settings as the bench (returns the running session)
    spark.sparkContext.setLogLevel("ERROR")
    registry.QUERIES["conversion_curve"](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    wall = {}
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        wall[name] = time.perf_counter() - t0
    spark.stop()
    stats = parse(log_dir)
    print(f"| query | wall s | shuffle written | shuffle records | tasks |  (sf dir `{sf_dir}`)")
    print("|---|---|---|---|---|")
    for name in names:
        s = stats[name]
        print(f"| {name} | {wall[name]:.2f} | {s['shuffle_write'] / 1024:.0f} KiB | {s['shuffle_records']} | {s['tasks']} |")


if __name__ == "__main__":
    main()
