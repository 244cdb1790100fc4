import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from parchment.llm.common import crc_mod
from parchment.llm.langid import UNKNOWN, Model, fit, grams_of, identify, keep_known, letters, predict, word_score

EN, DE = "the cat and the dog are in the house with a hat", "die katze und der hund sind in dem haus mit einem hut"


def test_letters():
    assert letters("Über-straße 12x_y") == ["über", "straße", "x", "y"] and letters("") == []


def test_backoff():
    m = Model(["a", "b"], np.zeros(2), {"cat": np.array([-1.0, -5.0])}, {"og": np.array([-2.0, -3.0]), "d": np.array([-9.0, -1.0])})
    assert word_score(m, "cat").tolist() == [-1.0, -5.0] and word_score(m, "dog").tolist() == [-2.0, -3.0] and word_score(m, "d").tolist() == [-9.0, -1.0] and word_score(m, "zzz").tolist() == [0.0, 0.0]
    assert grams_of("ab", 3) == [" ab", "ab "]


def test_predict_against_plain_sums(make):
    docs = make([(i, t, x) for i, (t, x) in enumerate([(EN, "en"), (DE, "de"), (EN + " house", "en"), ("the hund", "de"), (None, "en"), ("12 !", "en"), ("", "de"), ("қaz", "en"), (EN, None)])])
    m = fit(docs)
    assert m.langs == ["de", "en"]
    for r in predict(docs, m).collect():
        words = [w for w in letters(r.text or "") if any(map(str.isalpha, w))]
        if not words:
            assert (r.lang_pred, r["score"]) == (UNKNOWN, 0.0) or r.lang_pred == UNKNOWN
            continue
        s = sum(word_score(m, w) for w in words) + m.prior
        p = np.exp(s - s.max()) / np.exp(s - s.max()).sum()
        assert r.lang_pred == m.langs[int(p.argmax())]


def test_score_column(make):
    got = predict(make([(1, EN), (2, None)]).drop("score"), fit(make([(1, EN, "en"), (2, DE, "de")]))).orderBy("doc_id").collect()
    assert got[0].lang_pred == "en" and 0.5 < got[0].score <= 1 and got[1].score == 0.0


def test_odd(make, odd):
    docs = make(odd)
    got = identify(docs, docs)
    assert got.count() == len(odd) and {r.lang_pred for r in got.where("id IN (4, 5, 6, 8)").collect()} == {UNKNOWN}
    kept = keep_known(docs, docs)
    assert kept.columns == docs.columns and 4 not in [r.doc_id for r in kept.collect()]


def test_nothing_learned(make):
    assert identify(make([(1, EN)]), make([])).first().lang_pred == UNKNOWN
    assert identify(make([]), make([])).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = identify(docs, docs.where(crc_mod("doc_id", 5) != 0)).join(docs.withColumnRenamed("doc_id", "id"), "id").where(crc_mod("id", 5) == 0)
    assert out.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0] > 0.97
