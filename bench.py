"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is fully materialised with the ``noop`` sink (every row computed,
nothing collected to the driver).  Every headline query first runs once on the
sf0.01 dataset (10x smaller than the default) so JIT-compiled regex/codegen paths and Python
workers are warm; the timed runs are then steady-state.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scriptorium.plans import registry  # noqa: E402
from scriptorium.session import build_session  # noqa: E402

HEADLINE = (
    "corpus_token_stats",
    "corpus_deciles",
    "corpus_size_split_by_lang",
    "unwrap_paragraphs",
    "normalize_tokens",
    "catalog_talks",
    "pair_scores",
    "merged_lineage",
    "talk_index",
    "pair_scores_edited",
    "diff_spans_top",
    "edited_gate",
    "catalog_csv_talks",
    "log_warnings",
    "log_latest",
    "version_compare",
    "top_regressions",
    "accuracy_histogram",
    "transform_metrics",
    "manifest_duplicates",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus * 2, 8))
    qs = registry.all_queries()
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")
    for name in HEADLINE:
        if os.path.isdir(warm_dir):
            qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
