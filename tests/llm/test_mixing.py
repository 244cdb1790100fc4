import math
import re
from collections import Counter

import pytest

from parchment.llm.mixing import mix, repeat, targets


def shares(sizes, most=3.0):
    """Targets by sharing again and again until none is above its bound."""
    left, out, total = dict(sizes), {}, float(sum(sizes.values()))
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes, key=lambda x: (x is None, x or "")))}
    while left:
        level = (total - sum(out.values())) / sum(weight[s] for s in left)
        over = [s for s in left if level * weight[s] > most * sizes[s] * (1 + 1e-12)]
        if not over:
            return out | {s: level * weight[s] for s in left}
        out |= {s: most * sizes[s] for s in over}
        left = {s: x for s, x in left.items() if s not in over}
    return out


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 1, "c": 2, "d": 3, None: 5}, {"a": 0, "b": 7}, {"é": 5, "z": 5, "Z": 90}, {"a": 0}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in targets(df).collect()}
    want = shares(sizes)
    assert all(abs(got[s] - want[s]) <= 1e-9 * max(1, want[s]) for s in sizes)


def test_mix(make, odd):
    rows = [*odd, *[(100 + i, "w " * (i % 37 + 1), "en", f"s{i % 5}") for i in range(400)]]
    got = mix(make(rows)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    want = shares(sizes)
    taken = Counter()
    for r in got:
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3 and r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[f"s{i}"] - want[f"s{i}"]) <= 1 for i in range(5))
    again = mix(make(rows)).collect()
    assert sorted(str((r.id, r.size, r.taken)) for r in got) == sorted(str((r.id, r.size, r.taken)) for r in again)


def test_longer_documents_are_tilted_with_the_source(make):
    rows = [(i, "w " * (10 if i % 2 else 100), "en", "a") for i in range(50)] + [(100 + i, "w " * 100, "en", "b") for i in range(50)]
    rates = {(r.source, r.size): r.rate for r in mix(make(rows)).collect()}
    assert rates["a", 100] < rates["a", 10] < 1 < rates["b", 100]


def test_repeat(make, odd):
    docs = make(odd)
    got = repeat(docs)
    assert got.columns == docs.columns
    times = Counter()
    for r in mix(docs).collect():
        times[r.id, r.size] += r.copies
    seen = Counter((r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in got.collect())
    assert +times == seen


def test_empty(make):
    assert mix(make([])).count() == 0 and repeat(make([])).count() == 0


@pytest.mark.parametrize("rows", [[(1, "", "en", "a"), (2, "a b", "en", "a")], [(1, None, "en", None), (2, "", "en", None)], [(1, "", "en", "a"), (2, None, "en", "b"), (3, "x y z", "en", None)]])
def test_documents_without_words(make, rows):
    got = mix(make(rows)).collect()
    assert len(got) == len(rows) and all(r.copies == r.taken == r.rate == 0 for r in got if not r.size)
    total = sum(r.size for r in got)
    assert sum(r.taken for r in got) <= 3 * total and repeat(make(rows)).where("coalesce(trim(text), '') = ''").count() == 0


def test_rates_solve_the_dual(make):
    """Each source's exact rates, tilted by one number a source, meet its target."""
    rows = [(i, "w " * (i % 41 + i % 7 * 30 + 1), "en", f"s{i % 7}") for i in range(700)]
    got = mix(make(rows)).collect()
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert abs(sum(r.rate * r.size for r in own) - own[0].target) < 1e-6 * own[0].target
        lams = [math.log(r.rate) / r.size for r in own if 0 < r.rate < 3]
        assert not lams or max(lams) - min(lams) < 1e-9


def test_many_sources(make):
    rows = [(i, "w " * (i * 7919 % 13), "en", None if i % 50 == 49 else f"host{i % 50 * 31 % 997}") for i in range(500)]
    got = mix(make(rows)).collect()
    sizes = Counter()
    for r in got:
        sizes[r.source] += r.size
    want = shares(sizes)
    assert all(abs(r.target - want[r.source]) <= 1e-6 * max(1, want[r.source]) for r in got)
