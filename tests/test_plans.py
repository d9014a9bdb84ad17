"""Plan properties the design relies on, checked on the physical plans."""

import re

import pytest

from clickflow.plans import REGISTRY
from checks import SF_SMALL

BATCH = sorted(k for k, q in REGISTRY.items() if not q.streaming and k != "file_sink_roundtrip")


def plan(spark, key):
    return REGISTRY[key].build(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", BATCH)
def test_no_nested_loop_or_cartesian_join(spark, key):
    p = plan(spark, key)
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


@pytest.mark.parametrize("key", ["topn_sliding", "topn_report", "topn_sliding_10s"])
def test_top_n_limits_before_the_shuffle(spark, key):
    assert "WindowGroupLimit" in plan(spark, key) and "Partial" in plan(spark, key)


def test_filter_pushed_to_scan(spark):
    assert "EqualTo(user_id,13)" in plan(spark, "filter_user")


def test_word_count_reads_only_text(spark):
    p = plan(spark, "word_count")
    assert "ReadSchema: struct<text:string>" in p


RUNNING = {"word_count_running": 3, "user_frequency_running": 3, "max_by_user_running": 3, "maxby_user_running": 3,
           "running_sum_nulls": 3, "changelog_count": 3, "most_active_user_running": 5}


def executed(df):
    """The plan that ran, without the initial one."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("key", RUNNING)
def test_running_forms_read_their_input_once(spark, key):
    """Rows and block summaries come from one exchange: one scan, one shuffle
    of rows, no join, and as many shuffles in all as the scan states."""
    p = executed(REGISTRY[key].build(spark, "/root/testdata/sf0.01"))
    assert p.count("FileScan") == 1 and "ReusedExchange" in p and "Join" not in p
    stages = set(re.findall(r"(?<!Reused)Exchange (?:hashpartitioning|SinglePartition).*plan_id=(\d+)", p))
    assert len(stages) <= RUNNING[key]


def test_distinct_visitors_without_count_distinct(spark):
    p = plan(spark, "pv_uv_tumbling")
    assert "count(distinct" not in p.lower()


def test_words_are_counted_where_their_documents_lie(spark):
    """Documents are dealt out by block and their words made afterwards: no word row is shuffled."""
    p = executed(REGISTRY["word_count_running"].build(spark, "/root/testdata/sf0.01"))
    dealt = re.findall(r"(?<!Reused)Exchange hashpartitioning\(([^)]*)\)", p)
    assert any(re.fullmatch(r"_blk#\d+L, \d+", d) for d in dealt) and not any("word#" in d and "_blk#" in d for d in dealt)
    assert not any("_k0#" in d and "_blk#" in d for d in dealt)
