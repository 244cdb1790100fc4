import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from parchment.llm import simhash
from parchment.llm.common import Shared
from parchment.llm.graph import connected_components
from parchment.llm.simhash import anchors, classes, decode, fingerprint, flips, near_dedup, near_groups


def plain(text, n=3):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    w = [x for x in w if x]
    grams = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reach(ids, fps, t=2):
    """Component of each row by brute force."""
    fps = np.array(fps, np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= t
    label = np.array([10**18 if i is None else i for i in ids])
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return [None if x == 10**18 else int(x) for x in label]
        label = new


def test_fingerprint(odd, monkeypatch):
    for step in (1 << 18, 5):
        monkeypatch.setattr(simhash, "STEP", step)
        assert all(fingerprint(t or "") == plain(t) for _, t, *_ in odd)


def test_covering_radius():
    rng = np.random.default_rng(1)
    f = rng.integers(0, 2**64, 500, dtype=np.uint64)
    assert np.bitwise_count(f ^ decode(f)).max() <= 8
    g = f ^ rng.choice(flips(2), len(f))
    mine, theirs = [set() for _ in f], [set() for _ in f]
    for sets, x in ((mine, f), (theirs, g)):
        at, anchor = anchors(x, 1)
        assert np.bitwise_count(x[at] ^ anchor).max() <= 8 + 2
        for i, a in zip(at.tolist(), anchor.tolist(), strict=True):
            sets[i].add(a)
    assert all(a & b for a, b in zip(mine, theirs, strict=True))


def crowd():
    """Distinct fingerprints, many of them within a few bits of one."""
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    fps = [0, 1, 2**63, 2**64 - 1, *(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(120)), *(rng.getrandbits(64) for _ in range(30))]
    return list(dict.fromkeys(fps))


@pytest.mark.parametrize("most", [4096, 3])
def test_classes_of_crowded_fingerprints(spark, most):
    fps = crowd()
    rows = [(i, int(np.uint64(f).astype(np.int64))) for i, f in enumerate(fps)]
    got = {r.fp: r.component for r in classes(spark.createDataFrame(rows, "id long, fp long"), Shared(spark, "t"), 2, most).collect()}
    assert [got[f] for _, f in rows] == reach([i for i, _ in rows], fps)


@pytest.mark.parametrize(("small", "most", "size"), [(16, 4096, 1000), (2, 4096, 7), (16, 3, 5), (2, 3, 1)])
def test_links_at_anchors(monkeypatch, small, most, size):
    monkeypatch.setattr(simhash, "SMALL", small)
    f = np.array(crowd(), np.uint64)
    at, anchor = anchors(f, 1)
    order = np.lexsort((f[at], anchor.view(np.int64)))
    a, x, i = anchor.view(np.int64)[order], f[at][order].view(np.int64), at[order]
    batches = [pa.RecordBatch.from_arrays([pa.array(c[s : s + size], pa.int64()) for c in (a, x, i)], ["anchor", "fp", "id"]) for s in range(0, len(a), size)]
    up = {}
    find = lambda y: y if up.get(y, y) == y else find(up[y])
    spilled = set()
    for b in simhash._compare(iter(batches), 1, most):
        for u, v, spill in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if spill:
                spilled.add((u, v))
            else:
                assert bin(int(f[u]) ^ int(f[v])).count("1") <= 2
                up[max(find(u), find(v))] = min(find(u), find(v))
    counts = np.unique(a, return_counts=True)[1]
    assert bool(spilled) == bool((counts > most).any())
    for u, v in simhash.midpoint_links(np.array([y for _, y in spilled], np.int64).view(np.uint64), np.array([y for y, _ in spilled], np.int64), 1) if spilled else []:
        up[max(find(u), find(v))] = min(find(u), find(v))
    assert [find(y) for y in range(len(f))] == reach(range(len(f)), f)


def test_groups(make, odd):
    got = near_groups(make(odd)).collect()
    want = reach([r[0] for r in odd], [plain(r[1]) for r in odd])
    assert sorted(str((r.id, r.fp & (2**64 - 1), r.component)) for r in got) == sorted(str((r[0], plain(r[1]), c)) for r, c in zip(odd, want, strict=True))


def test_dedup(make, odd):
    docs = make(odd)
    got = near_dedup(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted({c for c in reach([r[0] for r in odd], [plain(r[1]) for r in odd]) if c is not None} | {3}) or len(rows) == len(set(reach([r[0] for r in odd], [plain(r[1]) for r in odd]))) + 1
    assert near_dedup(make([])).count() == 0 and near_groups(make([])).count() == 0


def test_thresholds(make):
    with pytest.raises(ValueError, match="even"):
        near_groups(make([(1, "a")]), threshold=3)


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)] + [(500, x) for x in range(501, 540)]
    up = {}
    find = lambda x: x if up.get(x, x) == x else find(up[x])
    for a, b in edges:
        up[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long"), Shared(spark, "t")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert connected_components(spark.createDataFrame([], "u long, v long"), Shared(spark, "t")).count() == 0


def test_fingerprints_replace_their_own_name(make, odd):
    from parchment.llm.simhash import fingerprints

    docs = make(odd)
    rest = [c for c in docs.columns if c != "fp"]
    got = fingerprints(docs)
    assert got.columns == [*rest, "fp"] and got.select(*rest).exceptAll(docs.select(*rest)).count() == 0
    assert fingerprints(docs, name="extra").columns == [*docs.columns, "extra"]
