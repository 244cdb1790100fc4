import os

import numpy as np
import pytest

from parchment.llm.common import crc_mod
from parchment.llm.quality import FEATURES, SHAPES, calibrate, features, fit, fit_nnpu, rate_documents, score, shape


def test_shape():
    assert shape("Hello,") == "Aa," and shape("x12") == "a0" and shape("!!!!!") == "!+" and shape("Straße") == "Aa"


def test_features(odd):
    for _, t, *_ in odd:
        x = features(t or "")
        assert x.shape == (FEATURES + SHAPES,) and np.isfinite(x).all()


def test_nnpu_separates_without_negatives():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (3000, 5)), rng.normal(-1, 1, (1000, 5))
    m = fit_nnpu(good[:1500], np.concatenate([good[1500:], bad]), 0.6)
    f = m.raw(np.concatenate([good, bad]))
    y = np.r_[np.ones(3000), np.zeros(1000)]
    assert ((f > 0) == y).mean() > 0.9
    calibrate(m, np.concatenate([good, bad]), y)
    assert ((m.score(np.concatenate([good, bad])) > 0.5) == y).mean() > 0.9


def test_odd(make, odd, spark):
    docs = make(odd)
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (8, 0), (10, 0), (None, 1), (99, None), (99, 0)], "doc_id long, quality int")
    got = rate_documents(docs, docs, labels).collect()
    assert len(got) == len(odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert len({r.score for r in got if r.id == 2}) == 1
    assert rate_documents(docs.limit(0), docs, labels).count() == 0


def test_without_labels(make, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert fit(make([(1, "a")]), none) is None
    assert score(make([(1, "a")]).drop("score"), None).first().score == 0.5


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    learn = crc_mod("doc_id", 4) != 2
    got = rate_documents(docs, docs.where(learn), labels.where(learn)).join(labels.withColumnRenamed("doc_id", "id"), "id").where(crc_mod("id", 4) == 2).collect()
    good, bad = (np.array([r.score for r in got if r.quality == q]) for q in (1, 0))
    assert (good[:, None] > bad[None, :]).mean() > 0.93
    assert np.mean([r.predicted == r.quality for r in got]) > 0.9


def test_own_names_are_replaced(make, odd, spark):
    """Columns that have the new one's name already give way; all others stay, and with them the order of columns."""
    docs = make(odd)
    assert {"score", "fp"} <= set(docs.columns)
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (9, 1), (8, 0)], "doc_id long, quality int")
    model = fit(docs, labels)
    rest = [c for c in docs.columns if c != "score"]
    got = score(docs, model)
    assert got.columns == [*rest, "score"] and got.select(*rest).exceptAll(docs.select(*rest)).count() == 0 and got.where("score < 0 OR score > 1").count() == 0
    assert score(docs, None).select("score").distinct().count() == 1


def test_prior_without_negatives():
    from parchment.llm.quality import estimate_prior

    rng = np.random.default_rng(3)
    for share in (0.2, 0.5, 0.9):
        n = int(20_000 * share)
        free = np.concatenate([rng.normal(2, 1, n), rng.normal(-2, 1, 20_000 - n)])
        assert abs(estimate_prior(rng.normal(2, 1, 5000), free, np.ones(len(free))) - share) < 0.04
    assert estimate_prior(np.empty(0), np.zeros(3), np.ones(3)) == 0.5


def test_labels_of_bad_documents_play_no_part(make, spark):
    rows = [(i, ("Plain words make a sentence here. " * 3 if i % 3 else "xx !! 00 ") + str(i), "en", "x") for i in range(90)]
    good = [(i, 1) for i in range(90) if i % 3 == 1]
    bad = [(i, 0) for i in range(90) if i % 3 == 0]
    one, other = (rate_documents(make(rows), make(rows), spark.createDataFrame(x, "doc_id long, quality int")).collect() for x in (good, good + bad))
    assert sorted((r.id, r.score) for r in one) == sorted((r.id, r.score) for r in other)
    by_filter = rate_documents(make(rows), lambda d: d.where("id >= 0"), spark.createDataFrame(good, "doc_id long, quality int")).collect()
    assert sorted((r.id, round(r.score, 6)) for r in one) == sorted((r.id, round(r.score, 6)) for r in by_filter)
