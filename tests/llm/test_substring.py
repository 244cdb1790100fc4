import hashlib
import random
import re

import numpy as np
import pytest

from parchment.llm import substring as M
from parchment.llm.substring import Texts, remove_repeats

W = 13


def brute(rows):
    big = 2**63 - 1
    docs = [(big if i is None else i, i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows]
    least = {}
    for key, _, w in docs:
        for s in range(len(w) - W + 1):
            g = tuple(w[s : s + W])
            least[g] = min(least.get(g, big), key)
    out = []
    for key, i, w in docs:
        gone = [False] * len(w)
        for s in range(len(w) - W + 1):
            if least[tuple(w[s : s + W])] < key:
                gone[s : s + W] = [True] * W
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append(str((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)))
    return sorted(out)


def check(docs, rows):
    assert sorted(str((r.id, r.n_words, r.n_removed, r.kept_sha256, r.kept)) for r in remove_repeats(docs).collect()) == brute(rows)


def corpus(seed):
    """Documents out of few words, with passages, copies, runs and near copies shared in all ways."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "c", "dd", "e", "f" * rng.randint(1, 3)])
    prose = lambda n: [word() for _ in range(n)]
    passages = [prose(rng.choice([12, 13, 14, 20, 60, 200])) for _ in range(8)]
    rows = []
    for i in range(60):
        w = prose(rng.choice([0, 5, 12, 13, 30]))
        for _ in range(rng.randint(0, 3)):
            w += rng.choice(passages) + prose(rng.randint(0, 6))
        if rng.random() < 0.2:
            w += ["z"] * rng.choice([5, 12, 13, 14, 40])
        if rows and rng.random() < 0.3:
            w = rows[rng.randrange(len(rows))][1].split()
            if w and rng.random() < 0.7:
                w[rng.randrange(len(w))] = "changed"
        rows.append((rng.choice([i, i, i, 1000 - i]), " ".join(w), "en", "x"))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(make, seed):
    rows = corpus(seed)
    check(make(rows), rows)


def test_odd(make, odd):
    check(make(odd), odd)
    assert remove_repeats(make([])).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_equal_windows_choose_equal_phrases(seed):
    rng = random.Random(seed)
    prose = lambda n: [rng.choice("abcd") for _ in range(n)]
    same = prose(W)
    before = [prose(rng.randint(0, 9)) for _ in range(6)]
    with np.errstate(over="ignore"):
        t = Texts([" ".join(left + same + prose(rng.randint(0, 9))) for left in before])
        best = t.phrases(t.levels()[0])
    chosen = {int(best[f + len(left)]) for f, left in zip(t.first, before, strict=True)}
    assert len(chosen) == 1 and int(M._FAR) not in chosen


def test_documents_do_not_touch():
    """The same symbols, alone or among others."""
    texts = ["a b c d e f g h i j k l m n o p", "", "p o n m l k", "a a a a a a a a a a a a a a b"]
    with np.errstate(over="ignore"):
        t = Texts(texts)
        best, (name, s, e, of) = t.phrases(t.levels()[0]), t.passages(t.levels()[1])
        for i, x in enumerate(texts):
            u = Texts([x])
            assert np.array_equal(u.phrases(u.levels()[0]), best[t.of == i])
            own = u.passages(u.levels()[1])
            assert np.array_equal(own[0], name[of == i]) and np.array_equal(own[1], s[of == i] - t.first[i])


def test_levels_of_symbols():
    with np.errstate(over="ignore"):
        t = Texts([" ".join(map(str, range(20_000)))])
        low, top = t.levels()
    assert np.diff(np.r_[low.starts, t.n]).max() <= 4
    assert 20 < t.n / len(top.names) < 300 and top.starts[0] == 0


@pytest.mark.parametrize("block", [1, 50, 1 << 20])
def test_words_without_a_step_for_each(monkeypatch, block):
    """Words, their names and what is kept of them come from the bytes of all texts at once."""
    monkeypatch.setattr(M, "BYTES", block)
    assert not hasattr(M, "words_of")
    rng = random.Random(6)
    words = ["a", "b", "ab", "ba", "aab", "é", "中", "x" * 32, "x" * 33, "x" * 70 + "ab", "x" * 70 + "ba", "\x0b", "\u00a0"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "\n\t", "  ", "\r", "\x0c"]) for _ in range(rng.randint(0, 40))) for _ in range(30)]
    texts += ["", " ", "\n", " lead", "trail ", "\x00 \x1f"]
    want = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    flat = [w for ws in want for w in ws]
    t = Texts(texts)
    assert t.counts.tolist() == list(map(len, want)) and t.n == len(flat)
    assert [t.flat[a:b].tobytes().decode() for a, b in zip(t.starts, t.ends, strict=True)] == flat
    name = dict(zip(flat, t.names.tolist(), strict=True))
    assert [name[w] for w in flat] == t.names.tolist() and len(set(name.values())) == len(name)
    gone = np.array([rng.random() < 0.4 for _ in flat])
    kept = iter(gone.tolist())
    assert t.without(gone) == [" ".join([w for w in ws if not next(kept)]).encode() for ws in want]
    assert Texts([]).n == 0 and Texts([]).without(np.zeros(0, bool)) == []


def test_slices(monkeypatch, make, odd):
    import pyarrow as pa

    monkeypatch.setattr(M, "CHARACTERS", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(["abc", "x" * 50, "", "de", "f" * 9])], ["text"])
    parts = list(M._slices(iter([batch, batch.slice(0, 0)])))
    assert pa.concat_arrays([p.column(0) for p in parts]).equals(batch.column(0)) and len(parts) > 1


def test_long_repeats_are_verified(make):
    """Two texts of 4100 words that sums of powers modulo 2**64 can't tell apart: swaps at all subset sums of 16 * 2**i, by parity."""
    a = [f"w{i}" for i in range(4100)]
    b = list(a)
    for n in range(256):
        at, odd = 16 * n, bin(n).count("1") % 2
        a[at], b[at] = ("UU", "VV") if odd else ("VV", "UU")
    rows = [(1, " ".join(a), "en", "x"), (2, " ".join(b), "en", "x")]
    check(make(rows), rows)


def test_many_rows_without_an_id(make):
    rng = random.Random(3)
    prose = [" ".join(rng.choice("abcdefgh") for _ in range(40)) for _ in range(5)]
    rows = [(None, rng.choice(prose) + f" x{i % 7} " + rng.choice(prose), "en", "x") for i in range(30)] + [(5, prose[0], "en", "x")]
    check(make(rows), rows)
