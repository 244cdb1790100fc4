import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from parchment.llm import exact as M
from parchment.llm.exact import Index, exact_dedup, exact_groups


def brute(rows, keep):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    best = {t: (max if keep == "max" else min)(ids, key=lambda x: (x is not None, x or 0)) for t, ids in groups.items()}
    return sorted(str((r[0], best[r[1] or ""], len(groups[r[1] or ""]), hashlib.sha256((r[1] or "").encode()).hexdigest())) for r in rows)


def test_groups(make, odd):
    for keep in ("max", "min"):
        got = exact_groups(make(odd), keep=keep).collect()
        assert sorted(str((r.id, r.keep_id, r.group_size, r.digest)) for r in got) == brute(odd, keep)
        assert sum(r.kept for r in got) == len({r[1] or "" for r in odd})
        assert all(r.id == r.keep_id for r in got if r.kept)


def test_colliding_digests_are_told_apart_by_bytes(make, odd):
    weak = lambda t: F.sha2((F.length(t) % 2).cast("string").cast("binary"), 256)
    got = exact_groups(make(odd), keep="max", digest=weak).collect()
    want = exact_groups(make(odd), keep="max").collect()
    assert sorted(str((r.id, r.keep_id, r.group_size)) for r in got) == sorted(str((r.id, r.keep_id, r.group_size)) for r in want)
    assert sum(r.kept for r in got) == sum(r.kept for r in want)


def test_dedup_keeps_columns_and_one_row(make, odd):
    docs = make(odd)
    got = exact_dedup(docs, keep="max")
    assert got.columns == docs.columns
    assert sorted(r.text or "" for r in got.collect()) == sorted({r[1] or "" for r in odd})


def test_empty(make):
    assert exact_groups(make([])).count() == 0 and exact_dedup(make([])).count() == 0


def test_batches_gather_in_levels(make, spark, monkeypatch):
    """Many batches make the same index as one, in levels of fewer than FANOUT runs, and lookups find what is there."""
    monkeypatch.setattr(M, "FANOUT", 2)
    rows = [(i, f"text {i % 5}") for i in range(12)] + [(None, "text 1"), (40, None)]
    for keep in ("min", "max"):
        index = Index(spark, keep)
        for s in range(0, len(rows), 5):
            index.insert(make(rows[s : s + 5]))
        assert all(len(level) < 2 for level in index.levels) and len(index.runs()) == 2
        whole = Index(spark, keep)
        whole.insert(make(rows).repartition(5))
        got, want = ({r.digest: (r.k.id, r.n) for r in i.all().collect()} for i in (index, whole))
        assert got == want and len(got) == 6
        asked = spark.createDataFrame([(hashlib.sha256(t.encode()).hexdigest(),) for t in ("text 1", "", "never")], "digest string")
        assert {r.digest: (r.k.id, r.n) for r in index.lookup(asked).collect()} == {d: x for d, x in want.items() if d in {r.digest for r in asked.collect()}}


def test_filter_too_large_to_send(make, odd, monkeypatch):
    monkeypatch.setattr(M, "LARGEST", 1)
    got = exact_groups(make(odd), keep="max").collect()
    assert sorted(str((r.id, r.keep_id, r.group_size, r.digest)) for r in got) == brute(odd, "max")
    assert sorted(r.text or "" for r in exact_dedup(make(odd), keep="max").collect()) == sorted({r[1] or "" for r in odd})
