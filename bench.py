"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``; every run is forced through Spark's ``noop`` sink (full
computation, nothing collected to the driver).  One warm-up pass, then the
median of ``$BENCH_REPEAT`` (default 3) timed runs per query.  Prints one JSON
line on stdout.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "word_count", "word_count_running", "url_count_tumbling", "url_count_sliding", "topn_sliding",
    "topn_report", "pv_uv_tumbling", "udaf_pv_uv", "user_frequency_running", "maxby_user_running",
    "most_active_user_running", "latest_url_per_user", "changelog_count", "keyed_join",
    "timer_per_event", "periodic_user_pv", "parse_click_csv", "process_conditional",
    "stream_topn_sliding", "stream_periodic_user_pv", "stream_changelog_count",
]


def _default_heap() -> str:
    """12 GB, or 60% of the machine's memory when that is less."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(2, min(12, int(total * 0.6 / 2**30)))}g"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE

    from clickflow.session import build_session
    from clickflow.plans import REGISTRY

    mem = os.environ.get("BENCH_DRIVER_MEMORY") or _default_heap()
    spark = build_session(f"local[{cpus}]", app="clickflow-bench", shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": mem})

    def run(name: str) -> float:
        t0 = time.perf_counter()
        REGISTRY[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in only:
        try:
            run(name)  # warm-up (JIT, replay files, file listing caches)
            samples = [run(name) for _ in range(repeat)]
        except Exception as e:  # noqa: BLE001 - record and keep measuring the rest
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
            print(f"{name}: FAILED {failed[name]}", file=sys.stderr)
            continue
        times[name] = round(statistics.median(samples), 3)
        print(f"{name}: {times[name]}s {samples}", file=sys.stderr)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus), "repeat": repeat, "failed": failed}))
    spark.stop()


if __name__ == "__main__":
    main()
