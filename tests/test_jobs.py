import os

from pyspark.sql import functions as F

from clickflow.jobs import JOBS, click_file_sink, click_upsert_sink, run_job, run_stream_job
from clickflow.session import local_path, scratch_path
from checks import rows
from fixtures import CLICKS7, CLICKS_WINDOW, ms


def _csv(spark, clicks):
    d = local_path(scratch_path(spark, "test", "jobs"))
    os.makedirs(d)
    p = os.path.join(d, "clicks.csv")
    with open(p, "w") as f:
        f.write("\n".join(f"{u},{url}, {t}" for u, url, t in clicks))
    return p


def test_url_count_job_on_reference_golden(spark):
    out = run_job(spark, "url_count", _csv(spark, CLICKS_WINDOW))
    start = ms(2023, 9, 6, 22, 1, 50)
    got = rows(out.filter(F.col("window_start") == start), "url", "cnt")
    assert got == [("/a", 1), ("/abc@a=1?", 2), ("/al/a?", 2), ("/b/url/afs", 2)]


def test_running_jobs_on_reference_listing(spark):
    p = _csv(spark, CLICKS7)
    mx = run_job(spark, "max_timestamp_running", p).orderBy("seq").collect()
    assert [(r.user_id, r.url, int(r.value)) for r in mx][3] == ("b", "./h", 2002)
    active = run_job(spark, "most_active_user_running", p).orderBy("seq").collect()
    assert (active[-1].user_id, active[-1].cnt) == ("b", 4)


def test_every_job_runs(spark):
    p = _csv(spark, CLICKS7)
    for name in JOBS:
        assert run_job(spark, name, p).count() >= 0


def test_jobs_read_parquet_clicks(spark):
    import pyarrow as pa
    import pyarrow.parquet as pq
    d = local_path(scratch_path(spark, "test", "jobs-parquet"))
    os.makedirs(d)
    p = os.path.join(d, "clicks.parquet")
    pq.write_table(pa.table({"user": [u for u, _, _ in CLICKS7], "url": [x for _, x, _ in CLICKS7],
                             "timestamp": pa.array([t for _, _, t in CLICKS7], pa.int64())}), p)
    assert rows(run_job(spark, "user_frequency", p)) == [("a", 1), ("b", 4), ("c", 2)]
    assert rows(run_job(spark, "latest_url_per_user", p)) == [("a", "./home"), ("b", "./ada?id=3"), ("c", "./sdf")]


# ------------------------------------------------------------------ as streams

def _folder(spark, groups):
    """A folder of text files, one a micro-batch, in the order given."""
    d = local_path(scratch_path(spark, "test", "stream-jobs"))
    os.makedirs(d)
    for i, clicks in enumerate(groups):
        _add(d, i, clicks)
    return d


def _add(d, i, clicks):
    p = os.path.join(d, f"part-{i}.csv")
    with open(p, "w") as f:
        f.write("\n".join(f"{u},{url}, {t}" for u, url, t in clicks))
    os.utime(p, (1_700_000_000 + 10 * i,) * 2)


def _whole(spark, d):
    p = local_path(scratch_path(spark, "test", "whole")) + ".csv"
    with open(p, "w") as f:
        f.write("\n".join(open(os.path.join(d, n)).read() for n in sorted(os.listdir(d))))
    return p


CLOSING = [("end", "/end", CLICKS_WINDOW[-1][2] + 60_000)]
IN_PARTS = [CLICKS_WINDOW[:3], CLICKS_WINDOW[3:5], CLICKS_WINDOW[5:], CLOSING]


def _closed(df, end="window_end"):
    return df.filter(F.col(end) <= CLOSING[0][2])


def test_stream_jobs_equal_their_batch_jobs(spark):
    d = _folder(spark, IN_PARTS)
    whole = _whole(spark, d)

    def stream(name):
        return run_stream_job(spark, name, d, scratch_path(spark, "test", f"job-{name}"), max_files=1)

    got = stream("url_count")
    assert rows(got, "url", "cnt", "window_start", "text") == rows(_closed(run_job(spark, "url_count", whole)), "url", "cnt", "window_start", "text")
    start = ms(2023, 9, 6, 22, 1, 50)
    assert rows(got.filter(F.col("window_start") == start), "url", "cnt") == [("/a", 1), ("/abc@a=1?", 2), ("/al/a?", 2), ("/b/url/afs", 2)]
    got = stream("topn_report")
    assert rows(got) == rows(_closed(run_job(spark, "topn_report", whole)).select(*got.columns))
    got = stream("pv_uv")
    batch = run_job(spark, "pv_uv", whole)
    assert rows(got) == rows(batch.filter(F.col("window_start") + 5000 <= CLOSING[0][2]).select(*got.columns))
    for name, keys in (("periodic_pv", ("user_id", "tick", "pv", "msg")), ("user_frequency", ("user_id", "cnt")),
                       ("latest_url_per_user", ("user_id", "url")), ("timers", ("user_id", "kind", "at_ms", "msg"))):
        assert rows(stream(name), *keys) == rows(run_job(spark, name, whole), *keys), name
    assert rows(stream("map_user")) == sorted((u,) for part in IN_PARTS for u, _, _ in part)
    assert rows(stream("running_count_by_user"), "user_id", "n") == rows(
        run_job(spark, "changelog_count_by_user", whole).filter("op <> '-U'"), "user_id", "n")


def test_stream_job_goes_on_with_new_files(spark):
    d = _folder(spark, IN_PARTS[:2])
    folder = scratch_path(spark, "test", "job-resume")
    first = run_stream_job(spark, "periodic_pv", d, folder, max_files=1)
    before = first.count()
    for i in (2, 3):
        _add(d, i, IN_PARTS[i])
    got = run_stream_job(spark, "periodic_pv", d, folder, max_files=1)
    assert got.count() > before
    assert rows(got, "user_id", "tick", "pv") == rows(run_job(spark, "periodic_pv", _whole(spark, d)), "user_id", "tick", "pv")


def test_word_count_as_batch_and_stream(spark):
    d = local_path(scratch_path(spark, "test", "words"))
    os.makedirs(d)
    for i, text in enumerate(["hello world\nmy name is lihua", "how are you\nhello java"]):
        with open(os.path.join(d, f"{i}.txt"), "w") as f:
            f.write(text)
    want = sorted([("hello", 2)] + [(w, 1) for w in "world my name is lihua how are you java".split()])
    assert rows(run_job(spark, "word_count", d)) == want
    assert rows(run_stream_job(spark, "word_count", d, scratch_path(spark, "test", "words-job"), max_files=1)) == want


def test_jobs_of_a_user_and_of_two_inputs(spark):
    p = _csv(spark, CLICKS7[:3])
    assert [r.v for r in run_job(spark, "flatmap_conditional", p, user="b").orderBy("seq", "pos").collect()] == [
        "a", "1000", "./h", "1212", "b", "1212", "c", "1231"]
    assert rows(run_job(spark, "filter_user", p, user="b"), "user_id", "url") == [("b", "./h")]
    assert run_job(spark, "process_conditional", p, user="b").count() == 4
    q = _csv(spark, [("a", "x", 5), ("b", "y", 6), ("z", "y", 7)])
    assert rows(run_job(spark, "keyed_join", p, other=q), "text") == [("a 1000=>(a,5)",), ("b 1212=>(b,6)",)]
    assert rows(run_job(spark, "co_map_union", p, other=q)) == sorted([(f"left:{t}",) for _, _, t in CLICKS7[:3]] + [("right:5",), ("right:6",), ("right:7",)])


def test_file_and_upsert_sinks_of_click_streams(spark):
    from clickflow.sinks.rolling import read_rolled

    d = _folder(spark, [CLICKS7[:4], CLICKS7[4:]])
    out = click_file_sink(spark, d, scratch_path(spark, "test", "file-job"), max_files=1)
    assert sorted(r.value for r in read_rolled(spark, out).collect()) == sorted(
        f"Event{{user='{u}', url='{x}', timestamp={t}}}" for u, x, t in CLICKS7)
    got = click_upsert_sink(spark, d, scratch_path(spark, "test", "upsert-job"), max_files=1)
    assert rows(got) == [("a", "./home"), ("b", "./ada?id=3"), ("c", "./sdf")]
