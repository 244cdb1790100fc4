import math
import os
import pickle
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parchment.llm import lm_mixing as M
from parchment.llm.lm_mixing import score


def tokens(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", t), ""]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


SMALL = (8, 8, 9, 9, 10)


@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setattr(M, "SPELL_BITS", SMALL)


def model(seed=0, bits=SMALL):
    rng = np.random.default_rng(seed)
    seen = rng.integers(0, 50, sum(1 << b for b in bits)).astype(np.uint32)
    ones = np.floor(seen * rng.random(len(seen))).astype(np.uint32)
    return M.Model(bits, ones, seen, rng.normal(0.2, 0.1, (M.GATES, len(bits) + 1)), rng.uniform(0.05, 0.95, (M.CELLS, M.BINS)))


def spell(m, words):
    return M.log10_probability(m, M.spelled(words), len(words))


def test_closed_words_have_probabilities_that_sum_to_one(small):
    """All codes of at most one letter, and the rest of the mass under the other first bytes: no more than 1."""
    p = 10 ** spell(model(), [b"", *(bytes([b]) for b in range(256) if b not in (10, 32))])
    assert 0 < p.sum() <= 1 + 1e-9


def test_steps_make_no_difference(small, monkeypatch):
    words = [b"", b"alpha", "naïve".encode(), b"x" * 300, b"ab"]
    whole = spell(model(), words)
    monkeypatch.setattr(M, "STEP", 7)
    assert np.allclose(whole, spell(model(), words)) and np.allclose(whole, [spell(model(), [w])[0] for w in words])


def test_counts_against_plain_loop(small):
    words = [b"", b"abca", b"b"]
    ones, seen = M._count(SMALL, M.spelled(words))
    want_ones, want = np.zeros(len(ones)), np.zeros(len(seen))
    for w in words:
        for b in M.spelled([w]):
            for k in range(len(SMALL)):
                for x, s in zip(b.bit, b.slots[k], strict=True):
                    want[s] += 1
                    want_ones[s] += x
    assert np.array_equal(ones, want_ones) and np.array_equal(seen, want)


def test_sums_over_tasks():
    rng = np.random.default_rng(1)
    for kind in (np.int64, np.float64):
        parts = [(rng.integers(0, 3, 150_000).astype(kind), rng.integers(0, 9, 150_000).astype(kind)) for _ in range(20)]
        parts = [(np.minimum(a, b), b) for a, b in parts]
        rows = sorted([(r.column(0)[0].as_py(), r.column(1)[0].as_py()) for a, b in parts for r in M._blocks(a, b)], key=lambda r: r[0])
        batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["block", "data"])
        a, b = np.zeros(3 * M.BLOCK), np.zeros(3 * M.BLOCK)
        for r in M._summed(iter([batch.slice(0, 7), batch.slice(7)])):
            places, x, y = M._block(r.column(1)[0].as_py())
            at = r.column(0)[0].as_py() * M.BLOCK + places
            a[at], b[at] = x, y
        assert np.array_equal(a[:150_000], sum(p[0] for p in parts)) and np.array_equal(b[:150_000], sum(p[1] for p in parts))


def test_model_travels():
    m, n = model(), pickle.loads(pickle.dumps(model()))
    assert n.bits == m.bits and np.array_equal(m.ones, n.ones) and np.array_equal(m.seen, n.seen) and np.array_equal(m.weights, n.weights) and np.array_equal(m.refined, n.refined)


@pytest.mark.parametrize("x", [[], [0], [0, 255, 256, 2**40], [2**64 - 1, 0, 5]])
def test_packed(x):
    data = M.packed(np.array(x, np.uint64))
    assert M.unpacked(data + b"rest").tolist() == x and M.packed_size(data) == len(data)


def plain(rows):
    """For each row its tokens' orders, the levels of their contexts and log10 shares, by plain loops over all rows."""
    one, two, three, n = Counter(), Counter(), Counter(), 0
    for i, t, *_ in rows:
        if not held(i):
            w = ["^", "^", *tokens(t)]
            for k in range(2, len(w)):
                one[w[k]] += 1
                two[w[k - 1], w[k]] += 1
                three[w[k - 2], w[k - 1], w[k]] += 1
                n += 1
    out = []
    for i, t, *_ in rows:
        own, w, found = int(not held(i)), ["^", "^", *tokens(t)], []
        for k in range(2, len(w)):
            a, b, c = w[k - 2], w[k - 1], w[k]
            pair, last = (two[a, b] - own, one[b] - own) if k > 2 else (0, 0)
            levels = [next(j for j, e in enumerate([0, 1, 2, 4, 8, 32, 256, 1e99]) if x <= e) for x in (pair, last)]
            if pair > 0 and three[a, b, c] > own:
                found.append((3, *levels, math.log10((three[a, b, c] - own) / pair)))
            elif last > 0 and two[b, c] > own:
                found.append((2, *levels, math.log10((two[b, c] - own) / last)))
            elif one[c] > own:
                found.append((1, *levels, math.log10((one[c] - own) / (n - own))))
            else:
                found.append((0, *levels, 0.0))
        out.append(found)
    return out


def plain_bits(tokens_):
    """(bit, cell, slots, gate) of one text's orders, token by token."""
    out, before, run = [], [0, 0, 0, 0], 0
    for k, (order, two, one, _) in enumerate(tokens_):
        r = 0 if run == 0 else min(15, 1 + int(math.log2(run)))
        c = [two * 8 + one, before[0] * 64 + before[1] * 16 + before[2] * 4 + before[3], (before[0] * 4 + before[1]) * 8 + two, r * 8 + one, (before[0] * 8 + two) * 8 + one]
        for kind, (asked, bit) in enumerate([(two > 0, order == 3), (one > 0 and order != 3, order == 2), (order < 2, order == 1)]):
            if asked:
                out.append((int(bit), kind * 64 + before[0] * 16 + before[1] * 4 + before[2], [(j << 10) + kind * 256 + x for j, x in enumerate(c)], kind * 16 + r))
        before = [order, *before[:3]]
        run = run + 1 if order == 3 else 0
    return out


TEXTS = [f"the word{i % 7} of many words The end" for i in range(20, 60)] + ["a b a b a b a b", "zz a b a b zz"]


def test_states_and_shares_against_plain_loops(small):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "the end"), (100, None), (101, "x " * 300)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([not held(r[0]) for r in rows]), pa.array([r[1] or "" for r in rows])], ["id", "train", "text"])
    for deep in (0, 3):
        asked = [r for b in M._ask(iter([pa.RecordBatch.from_arrays([pa.array([7], pa.int64()), pa.array([M._body(batch)])], ["chunk", "body"])]), 40, deep) for r in b.to_pylist()]
        asked.sort(key=lambda r: (r["kind"], r["slice"]))
        got = [r for b in M._answer(iter([pa.RecordBatch.from_pylist(asked)])) for r in b.to_pylist()]
        answers = [np.concatenate([M.unpacked(r["payload"]) for r in got if r["kind"] == k and r["chunk"] == 7]) for k in range(3)]
        n, v = (sum(r[x] for r in got) for x in ("tokens", "types"))
        sizes, _, _, fixed, _, states = M._state(M.Chunk(batch), 40, answers, n, v, model())
        m = model()
        for row, want, f, s in zip(rows, plain(rows), fixed.to_pylist(), states.to_pylist(), strict=True):
            assert [(x & 3, (x >> 2) & 7, x >> 5) for x in s] == [x[:3] for x in want]
            spelled = sum(spell(m, [w.encode()])[0] for w, x in zip(tokens(row[1]), want, strict=True) if x[0] == 0)
            assert abs(f - spelled - sum(x[3] for x in want)) < 1e-9
    bits = M.order_bits([np.frombuffer(s, np.uint8) for s in states.to_pylist()])
    loop = [(k, *b) for k, want in enumerate(plain(rows)) for b in plain_bits(want)]
    assert bits.owner.tolist() == [x[0] for x in loop] and bits.bit.tolist() == [x[1] for x in loop] and bits.cell.tolist() == [x[2] for x in loop]
    assert bits.slots.T.tolist() == [x[3] for x in loop] and bits.gate.tolist() == [x[4] for x in loop]


def test_mixing_against_plain_loop():
    m = model(3, M.ORDER_BITS)
    states = [np.random.default_rng(k).integers(0, 256, 50).astype(np.uint8) for k in range(4)]
    got = M.log10_probability(m, iter([M.order_bits(states)]), 4)
    b = M.order_bits(states)
    want = np.zeros(4)
    for j in range(len(b.bit)):
        z = m.weights[b.gate[j], -1]
        for k in range(5):
            n, one = float(m.seen[b.slots[k, j]]), float(m.ones[b.slots[k, j]])
            z += m.weights[b.gate[j], k] * (math.log((one + 0.02) / (n - one + 0.02)) if n else 0.0)
        p = 1 / (1 + math.exp(-z))
        p = (p + m.refined[b.cell[j], min(M.BINS - 1, max(0, int((z + 12) * M.BINS / 24)))]) / 2
        want[b.owner[j]] += math.log10(min(max(p if b.bit[j] else 1 - p, 1e-9), 1 - 1e-9))
    assert np.allclose(got, want)


def test_scores(make, odd):
    rows = [*odd, *[(i, f"the word{i % 7} of many words The end", "en", "x") for i in range(20, 60)]]
    got = score(make(rows)).collect()
    c = Counter()
    for i, t, *_ in rows:
        if not held(i):
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted(str((i, held(i), len(w := tokens(t)), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 5))) for i, t, *_ in rows)
    assert sorted(str((r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5))) for r in got) == want
    assert all(r.score < 0 and r.bits_per_byte > 0 for r in got)
    one = {r.score for r in got if r.id == 2}
    assert len(one) == 1 and len([r for r in got if r.id == 2]) == 2


def test_order_of_words_counts(make):
    """A text in the order that was learned costs less than the same words in another."""
    text = "in the beginning there was the word and the word was long"
    out = [i for i in range(200) if held(i)][:2]
    rows = [(i, f"{text} {i}", "en", "x") for i in range(200) if not held(i)][:40] + [(out[0], text, "en", "x"), (out[1], " ".join(reversed(text.split())), "en", "x")]
    got = {r.id: r for r in score(make(rows)).collect()}
    assert got[out[0]].score > got[out[1]].score + 3 and abs(got[out[0]].base_score - got[out[1]].base_score) < 1e-9


def test_learning_helps(make):
    text = "in the beginning there was the word and the word was long"
    got = {r.id: r for r in score(make([(i, text if i < 39 else "qxz jjk vvw", "en", "x") for i in range(40)])).collect()}
    assert max(got[i].bits_per_byte for i in range(39)) < 2 < got[39].bits_per_byte


def test_empty(make):
    assert score(make([])).count() == 0
    only_held_out = next(i for i in range(100) if held(i))
    r = score(make([(only_held_out, "a b")])).first()
    assert r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0.0 and r.score < 0


def test_long_text_and_many_chunks(make, monkeypatch):
    rows = [(1, "a a a b b b c c c " * 3000, "en", "x"), (2, "a a a b b b c c c", "en", "x")]
    whole = sorted((r.id, round(r.score, 6), r.n_tokens) for r in score(make(rows)).collect())
    assert [x[2] for x in whole] == [27001, 10] and whole[0][1] < whole[1][1] < 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_held_out_above_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = score(docs).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    print(r[0] / r[2], r[1] / r[2])
    assert r[0] > r[1]


def test_distinct_names():
    from parchment.llm.lm_mixing import _distinct

    rng = np.random.default_rng(9)
    for names in (rng.integers(0, 50, 1000).astype(np.uint64), rng.integers(0, 1 << 63, 200).astype(np.uint64), np.array([7], np.uint64)):
        keys, at, inverse = _distinct(names)
        want, back = np.unique(names, return_inverse=True)
        assert (keys == want).all() and (names[at] == want).all() and (inverse == back).all()


def peak_mb(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_of_a_task():
    slots = sum(1 << b for b in M.SPELL_BITS)
    seen = np.arange(slots, dtype=np.uint32) % 50
    sent = pickle.loads(pickle.dumps(M.Model.blank(M.SPELL_BITS, seen // 2, seen)))
    assert peak_mb(lambda: sent.left_out) < 200 and peak_mb(lambda: sent.plain) < 150
    assert sum(x.nbytes for x in vars(sent).values() if isinstance(x, np.ndarray)) < 1e6 and np.array_equal(sent.ones, seen // 2) and np.array_equal(sent.seen, seen)
    assert peak_mb(lambda: M._count(M.SPELL_BITS, M.spelled([b"a"] * 1000))) < 100
    # Words have one name wherever they stand.
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([True, False]), pa.array(["some words " * 200_000, "words, some words"])], ["id", "train", "text"])
    assert peak_mb(lambda: M.Chunk(batch)) < 60
    chunk = M.Chunk(batch)
    assert chunk.sizes.tolist() == [400_001, 4] and len(set(chunk.names[:400_000:2].tolist())) == len(set(chunk.names[1:400_000:2].tolist())) == 1
    assert chunk.names[-3:-1].tolist() == chunk.names[:2].tolist()
