"""Quality rules (5), toxicity (7) and quality (8) classifiers, and the pipeline."""

import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from clickflow.llm import common, op3_golay_simhash, op5_mcd_rules as mcd, op7_nb_toxicity as nb, op8_rda_quality as rda, queries
from clickflow.llm.text_stats import base_counts
from helpers import awkward_docs, empty_docs

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines), len(lines) - len(set(lines)), len(covered))


def test_base_counts(spark):
    texts = [r.text for r in awkward_docs(spark).collect()] + ["a b c d e a b c d e f", "a a a a a a", "a a a a a", "x y\x85z \x1c#|", "l\nl\n\n \nl m"]
    texts += [r.text for r in common.table(spark, "/root/testdata/sf0.001", "documents").collect()]
    assert [base_counts(t) for t in texts] == [brute_counts(t) for t in texts]


def test_rules_on_awkward_rows(spark):
    common.prepare(spark)
    docs = awkward_docs(spark)
    got = mcd.rules(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept)
    assert mcd.keep_rows(docs).columns == docs.columns
    assert mcd.rules(empty_docs(spark)).count() == 0 and mcd.keep_rows(empty_docs(spark)).count() == 0


def test_estimate_ignores_outliers(spark):
    """One group with 15 % far rows: the estimate is that of the others."""
    common.prepare(spark)
    rnd = np.random.default_rng(1)
    x = np.r_[rnd.normal(0, 1, (850, mcd.P)), rnd.normal(15, 1, (150, mcd.P))]
    df = spark.createDataFrame([("en", "s", False, *map(float, r)) for r in x], ["lang_key", "source_key", "base_failed", *mcd.VECTOR])
    est = {(r.lang_key, r.source_key): r for r in mcd.estimates(df).collect()}
    assert set(est) == {("en", "s"), ("en", "*"), ("*", "*")}
    assert np.abs(np.array(est["en", "s"].center)).max() < 0.25
    out = mcd.judged(df, mcd.estimates(df)).collect()
    far = [abs(r.x_words) + abs(r.x_length) > 15 for r in out]
    assert sum(r.kept == f for r, f in zip(out, far)) <= 2


def test_rules_keep_clean_documents(spark):
    got = mcd.rules(common.table(spark, SF, "documents")).join(common.table(spark, SF, "labels"), "doc_id").where("not base_failed").collect()
    good, junk = ([r.kept for r in got if r.quality == q] for q in (1, 0))
    assert np.mean(good) >= 0.99 and np.mean(junk) <= 0.3


def check_scores(rows, folds, fold):
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % folds == fold)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


@pytest.mark.parametrize("op,folds,fold", [(nb, 5, 0), (rda, 3, 1)])
def test_classifiers_on_awkward_rows(spark, op, folds, fold):
    common.prepare(spark)
    docs = awkward_docs(spark)
    some = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 13)] + [(None, 1, 1), (1, None, None), (2, 0, 0)], LABELS)
    for labels in (some, spark.createDataFrame([], LABELS), some.where("toxic = 1")):
        rows = op.classify(docs, labels).collect()
        assert len(rows) == docs.count()
        check_scores(rows, folds, fold)
        assert op.classify(empty_docs(spark), labels).count() == 0


@pytest.mark.parametrize("name,label,least", [("op7_nb_toxicity", "toxic", 0.97), ("op8_rda_quality", "quality", 0.97)])
def test_held_out_accuracy(spark, name, label, least):
    rows = queries.QUERIES[name](spark, SF).join(common.table(spark, SF, "labels"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r[label] for r in rows]) >= least
    if label == "toxic":
        assert np.mean([r.predicted for r in rows if r.toxic == 0]) <= 0.01


def test_pipeline(spark):
    sf = "/root/testdata/sf0.01"
    docs = common.table(spark, sf, "documents")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    toxic = {r.doc_id for r in common.table(spark, sf, "labels").where("toxic = 1").collect()}
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf), "test-pipeline")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids
        seen.append(len(ids) - len(now))
        ids = now
    assert seen[0] > 0 and seen[1] > 0 and seen[2] == 0 and seen[3] > 0
    assert docs.count() == len(ids) and len(toxic & ids) < 0.5 * len(toxic)
    groups = op3_golay_simhash.groups(docs)
    assert groups.select("component_id").distinct().count() == docs.count()
    packed = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids
    assert packed.where("offset < 0 or offset + length > 2048").count() == 0
