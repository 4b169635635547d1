"""Benchmark the headline queries, as they are registered.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3; the minimum is reported).

Each query is forced to full evaluation with the ``noop`` sink (every
row is produced, nothing is collected), after one warm-up query.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sheaf.plans.queries import QUERIES  # noqa: E402
from sheaf.session import build_session  # noqa: E402

HEADLINE = (
    "top_normalized_ratings",
    "word_count",
    "word_count_salted",
    "word_count_salted_pairs",
    "word_count_partitionwise",
    "avg_word_length",
    "approx_silhouette_full",
    "exact_silhouette_full",
    "exact_silhouette_sample",
    "exact_silhouette_lineitem",
    "k_sweep_silhouette",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="sheaf-bench",
        shuffle_partitions=2 * cpus,
        driver_memory="16g",
    )
    # Warm-up: JIT, class loading, Parquet footers.
    QUERIES["vocabulary_size"](spark, sf_dir).collect()
    QUERIES["user_mean_rating"](spark, sf_dir).collect()

    timings: dict[str, float] = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(repeat):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        timings[name] = round(best, 3)
        print(f"{name}: {best:.3f} s", file=sys.stderr, flush=True)

    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
