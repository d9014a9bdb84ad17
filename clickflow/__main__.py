"""Command line: list queries, run one, show its plan.

    python -m clickflow list
    python -m clickflow run topn_sliding --sf /root/testdata/sf0.01 --show 20
    python -m clickflow explain keyed_join --sf /root/testdata/sf0.01
    python -m clickflow job topn_report --clicks clicks.csv     (lines: user,url, ms)
    python -m clickflow stream topn_report --clicks clicks_folder --out work_folder
"""

from __future__ import annotations

import argparse


def main() -> None:
    ap = argparse.ArgumentParser(prog="clickflow")
    ap.add_argument("command", choices=["list", "run", "explain", "job", "stream"])
    ap.add_argument("key", nargs="?")
    ap.add_argument("--sf", default="/root/testdata/sf0.01", help="folder with the parquet tables")
    ap.add_argument("--show", type=int, default=20, help="rows to print")
    ap.add_argument("--master", default=None, help="Spark master (default: from spark-submit / local[*])")
    ap.add_argument("--clicks", default=None, help="click file for `job`: .csv/.txt lines or parquet; folder or kafka:// for `stream`")
    ap.add_argument("--user", default=None, help="user of filter_user, flatmap_conditional, process_conditional")
    ap.add_argument("--other", default=None, help="second click input of co_map_union, keyed_join")
    ap.add_argument("--out", default=None, help="folder of a stream's output, checkpoint and state; given again, the stream goes on")
    a = ap.parse_args()

    if a.command in ("job", "stream"):
        from clickflow.jobs import JOBS, PAIR_JOBS, STREAM_JOBS, USER_JOBS, run_job, run_stream_job
        known = {*JOBS, *USER_JOBS, *PAIR_JOBS, "word_count"} if a.command == "job" else set(STREAM_JOBS)
        if a.key not in known or not a.clicks or (a.command == "stream" and not a.out):
            ap.error(f"{a.command} needs one of {sorted(known)}, --clicks" + (" and --out" if a.command == "stream" else ""))
        from pyspark.sql import SparkSession
        from clickflow.session import build_session
        spark = build_session(a.master) if a.master else (SparkSession.getActiveSession() or build_session("local[*]"))
        out = run_job(spark, a.key, a.clicks, a.user, a.other) if a.command == "job" else run_stream_job(spark, a.key, a.clicks, a.out)
        out.show(a.show, truncate=False)
        return

    from clickflow.plans import REGISTRY
    if a.command == "list":
        for name, q in REGISTRY.items():
            kind = "stream" if q.streaming else "batch "
            oracle = "sql" if q.sql else "   "
            print(f"{kind} {oracle} {name:28s} {q.doc.splitlines()[0] if q.doc else ''}")
        return
    if a.key not in REGISTRY:
        ap.error(f"unknown query {a.key!r}; see `python -m clickflow list`")
    from pyspark.sql import SparkSession
    from clickflow.session import build_session
    spark = build_session(a.master) if a.master else (SparkSession.getActiveSession() or build_session("local[*]"))
    df = REGISTRY[a.key].build(spark, a.sf)
    if a.command == "explain":
        df.explain("formatted")
    else:
        df.show(a.show, truncate=False)


if __name__ == "__main__":
    main()
