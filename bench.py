"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is
computed, nothing is collected to the driver). One warm-up run, then the
median of $BENCH_RUNS timed runs per query (fewer where they take longer than
$BENCH_QUERY_SEC together, none after $BENCH_TOTAL_SEC). Prints one JSON line,
also when it is told to stop before the end; progress goes to stderr.
"""

from __future__ import annotations

import json
import os
import signal
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "district_cube", "district_cube_monthly", "cube_latest_month", "legacy_view", "ind_growth_base", "ind_share", "left_join_key",
    "dq_unique_key", "dq_coverage_gap", "dq_rebuild_match", "dq_tolerance_diff",
    "corr_pairs_listwise", "corr_pairs_monthly", "corr_matrix_pairwise", "corr_spearman", "corr_kendall",
    "top_n", "top_bottom_report", "lookup_fallback", "basic_clean", "fill_forward",
    "lenient_numeric", "list_months", "latest_month_slice", "ingest_month",
    "train_frame", "regression_metrics", "score_requests",
    "holdout_exact", "rf_planted_score", "batch_score", "dq_referential", "cube_mixed_months", "ingest_month_stream", "corr_matrix_cube",
    "cube_from_exports",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    each, total_sec = float(os.environ.get("BENCH_QUERY_SEC", "45")), float(os.environ.get("BENCH_TOTAL_SEC", "900"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    times, done, began = {}, [], time.perf_counter()

    def report(*_):
        total = round(sum(v for v in times.values() if v is not None), 3)
        sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
        if not done:
            done.append(True)
            print(json.dumps({"metric": "headline_queries_total_median_sec", "value": total, "unit": "sec", "queries": times,
                              "sf": sf, "cpus": cpus, "runs": runs, "elapsed": round(time.perf_counter() - began, 1)}), flush=True)
        if _:
            os._exit(0)

    from gridcube.session import get_session
    spark = get_session(f"local[{cpus}]", app="gridcube-bench", shuffle_partitions=cpus * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g"),
                               "spark.sql.files.maxPartitionBytes": str(64 << 20),
                               "spark.checkpoint.dir": tempfile.mkdtemp(prefix="gridcube-bench-")})
    for s in (signal.SIGINT, signal.SIGTERM):
        signal.signal(s, report)

    from gridcube.plans.catalog import load
    from gridcube.session import cleanup
    QUERIES = load()[0]
    for name in only or HEADLINE:
        if time.perf_counter() - began > total_sec:
            print(f"# {name} and the rest left out: {total_sec:.0f} s are over", file=sys.stderr)
            break
        fn, samples, start = QUERIES[name], [], time.perf_counter()

        def once():
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        try:
            warm = once()
            while len(samples) < runs and (not samples or time.perf_counter() - start < each):
                samples.append(once())
            times[name] = round(statistics.median(samples), 3)
            cleanup(spark)
        except Exception as e:  # noqa: BLE001
            print(f"# {name} failed: {type(e).__name__}: {str(e)[:300]}", file=sys.stderr)
            times[name] = None
            continue
        print(f"# {name}: warm-up {warm:.2f} s, median {times[name]} s of {len(samples)}", file=sys.stderr)
    report()
    spark.stop()


if __name__ == "__main__":
    main()
