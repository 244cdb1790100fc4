"""Each stage on odd input, and the whole against the operators one by one."""

import math
import os
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from parchment.llm.langid import grams_of, letters

from test_mixing import shares

LONG = "the cat and the dog are in the house with a hat and the other cat is not there at all but it was seen"


def test_stages_keep_columns(make, odd, spark):
    docs = make([*odd, *[(50 + i, f"{LONG} number {i}", "en", f"s{i % 3}") for i in range(12)]])
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), "").count() == 0, name
    got = P.packed(spark, docs, "")
    assert {"doc_id", "piece", "start", "length", "sequence_id", "offset"} <= set(got.columns) and got.count() >= docs.count()


def test_decisions(make, spark):
    rows = [(1, LONG, "en", "a"), (2, LONG, "en", "a"), (3, None, "en", "a"), (4, "123", "en", "a"), (5, LONG + " and more words", "en", "a")]
    docs = make(rows)
    assert {r.doc_id for r in P.language(spark, docs, "").collect()} == {1, 2, 5}
    assert {r.doc_id for r in P.exact(spark, docs, "").collect()} == {2, 3, 4, 5}
    # 21 of the 24 shingles of 5 are those of 1: a similarity of 0.875.
    near = {r.doc_id for r in P.near(spark, make([*rows, (6, "quite another text that shares nothing with the first", "en", "a")]), "").collect()}
    assert near == {1, 3, 4, 6}


def test_stages_are_the_five():
    assert [n for n, _ in P.STAGES] == ["language", "exact", "near", "mix", "pack"] and P.ORACLE_SQL is None


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_run(spark):
    out = P.run(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, "")
    assert sorted(str(tuple(r)) for r in out.select("doc_id", "piece", "ids_crc32").collect()) == sorted(str(tuple(r)) for r in P.packed(spark, docs, "").select("doc_id", "piece", "ids_crc32").collect())


def by_hand(rows):
    """(ids kept by the first three stages, targets by source, sizes) of rows (doc_id, text, lang, source), by plain loops."""
    learned = [(t, x) for i, t, x, _ in rows if t is not None and x is not None and zlib.crc32(str(i).encode()) % 5]
    langs = sorted({x for _, x in learned})
    words = {x: Counter(w for t, y in learned if y == x for w in letters(t)) for x in langs}
    every = set().union(*words.values())
    grams = {x: Counter() for x in langs}
    for x in langs:
        for w, n in words[x].items():
            for k in range(1, 6):
                for g in grams_of(w, k):
                    grams[x][g] += round(1000 * n**0.5)
    known = set().union(*grams.values())

    def cost(w, x):
        if w in every:
            return math.log((words[x][w] + 0.1) / (words[x].total() + 0.1 * len(every)))
        for k in range(5, 0, -1):
            own = [g for g in known if len(g) == k]
            found = [g for g in grams_of(w, k) if g in known]
            if found:
                total = sum(grams[x][g] / 1000 for g in own)
                return sum(math.log((grams[x][g] / 1000 + 0.1) / (total + 0.1 * len(own))) for g in found) / len(found)
        return 0.0

    def told(t):
        own = [w for w in letters(t or "") if any(c.isalpha() for c in w)]
        if not own:
            return False
        s = [sum(cost(w, x) for w in own) + math.log(sum(y == x for _, y in learned) / len(learned)) for x in langs]
        return 1 / sum(math.exp(v - max(s)) for v in s) >= 0.5

    rows = [r for r in rows if told(r[1])]
    rows = [r for r in rows if r[0] == max(q[0] for q in rows if q[1] == r[1])]
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", r[1].lower())
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))})
    up = list(range(len(rows)))
    for _ in rows:  # until nothing changes: components
        for a in range(len(rows)):
            for b in range(len(rows)):
                if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                    up[a] = up[b] = min(up[a], up[b])
    rows = [min((rows[k] for k in range(len(rows)) if up[k] == c), key=lambda r: r[0]) for c in sorted(set(up))]
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))
    return rows, shares(sizes), sizes


def test_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    en, de = LONG.split(), "die katze und der hund sind in dem haus mit einem hut und die andere war nicht da".split()
    rows = []
    for i in range(60):
        own = en if i % 3 else de
        t = " ".join(rng.choice(own) + rng.choice(["", "", "", "s", "en"]) for _ in range(rng.randint(5, 60)))
        rows.append((i, t, "en" if i % 3 else "de", f"src{i % 4}" if i % 7 else None))
    rows += [(100 + i, rows[i][1], rows[i][2], "src9") for i in range(0, 20, 3)]
    rows += [(200 + i, f"{rows[i][1]} tail", rows[i][2], rows[i][3]) for i in range(0, 40, 5)] + [(300, None, "en", "x"), (301, "12 34 !", "de", "x"), (302, "", None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.lit(0).cast("long")).write.parquet(str(tmp_path / "documents.parquet"))
    got = P.run(spark, str(tmp_path)).collect()
    kept, targets, sizes = by_hand(rows)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    of, taken = {r[0]: r for r in kept}, Counter()
    copies = Counter(r.doc_id for r in got)
    assert set(copies) <= set(of) and max(copies.values()) <= 3 and len(of) > 40
    for r in got:
        ids = [*tokenizer.encode(of[r.doc_id][1], add_special_tokens=False).ids, 0]
        assert (r.piece, r.start, r.length) == (0, 0, len(ids)) and r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))
        taken[of[r.doc_id][3]] += len(of[r.doc_id][1].split())
    # Whole copies of few documents: within half of the largest one.
    off = {s: round(taken[s] - targets[s], 1) for s in sizes}
    assert all(abs(x) <= 30 for x in off.values()), off
    filled = Counter()
    for r in got:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 2048 and sum(r.offset == 0 for r in got) == len(filled)


def test_workers_remember_one_operator_at_a_time():
    """A worker that stages share holds what the last one remembers, and nothing of those before."""
    import pyarrow as pa

    from parchment.llm import common
    from parchment.llm.packing import TokenBytes

    path = public_tokenizers.path("byte_bpe_50k.json")
    common.keep("languages", lambda: [0] * 1000)
    known = TokenBytes.get(path)
    assert list(common._kept) == [("tokens", path)] and TokenBytes.get(path) is known
    parts = list(common.lean(iter([pa.RecordBatch.from_arrays([pa.array(range(2500))], ["x"])])))
    assert [len(p) for p in parts] == [1000, 1000, 500] and not common._kept


def test_folders_go_with_their_stage(make, spark):
    from parchment.llm.common import Shared, scratch

    with scratch():
        inner = Shared(spark, "inner")
        inner.save(make([(1, "a")]), "x")
        with scratch():
            Shared(spark, "other").save(make([(1, "a")]), "x")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(inner.path("x"))
    assert not Shared._open
