"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import time

from corpusmill.session import get_session
from corpusmill.workloads import all_queries

HEADLINE = (
    "label_centroids", "label_outliers", "zero_shot_categories", "near_duplicate_pairs",
    "duplicate_resolution", "mislabel_candidates", "verdict_stats", "eligible_labels", "burst_dedupe",
    "tier_fill", "best_detections", "quality_scores", "coco_annotations", "sample_random",
    "threshold_sweep", "split_dataset_rule", "merged_annotations", "balanced_resample",
    "classification_report", "loss_outliers", "top_classes", "frame_carry_forward", "early_stops",
    "verdict_capped", "dataset_stats", "report_summary", "merged_items", "streamed_categories",
    "streamed_top_classes",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", "bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    found = all_queries()
    found["label_centroids"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        found[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
