"""Bench: run the headline queries on ``$BENCH_SF_DIR`` (default sf0.1) on
``local[$BENCH_CPUS]`` and print one JSON line.

Each query runs to completion into Spark's ``noop`` sink (the whole plan
executes, nothing is collected to the driver).  The first query also pays
the session's warm-up, so one untimed warm-up query runs first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "encode_tokens_by_lang",
    "vocab_top_words",
    "row_index_docs",
    "split_ordered_docs",
    "batches_docs",
    "collate_sentence_batches",
    "classify_softmax",
    "cross_entropy_by_label",
    "clip_boxes_training",
    "drop_runaway_images",
    "iou_pairs_50",
    "greedy_matches",
    "average_precision_by_class",
    "detection_summary",
    "export_shards_manifest",
    "work_rounds_final_state",
    "target_paths",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from shardloom.plans.registry import QUERIES, load_all
    from shardloom.session import local_session

    n = int(cpus) if cpus.isdigit() else os.cpu_count() or 8
    spark = local_session(cpus, shuffle_partitions=max(2 * n, 8), app="shardloom-bench")
    load_all()

    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    for name in only or HEADLINE:  # untimed warm-up on the smallest scale
        src = warm if os.path.isdir(warm) else sf_dir
        QUERIES[name](spark, src).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]} s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
