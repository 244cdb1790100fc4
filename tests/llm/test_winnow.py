import hashlib
import random

import numpy as np
import pytest

from parchment.llm import winnow as M
from parchment.llm.winnow import edit_fingerprints, edited, fingerprint, likeness, winnow


def brute(t, k, w):
    k = min(k, len(t))
    with np.errstate(over="ignore"):
        h = (M._gram_hashes(np.frombuffer(t.encode("utf-32-le"), "<u4"), k) >> np.uint64(M._POSITION + 1)).astype(np.int64)
    w = min(w, len(h))
    return sorted({i + max(j for j in range(w) if h[i + j] == h[i : i + w].min()) for i in range(len(h) - w + 1)})


@pytest.mark.parametrize("step", [1 << 20, 7, 50])
def test_rightmost_minimum_of_each_window(monkeypatch, step):
    monkeypatch.setattr(M, "STEP", step)
    rng = random.Random(1)
    for _ in range(150):
        t, k, w = "".join(rng.choice("abé") for _ in range(rng.randint(1, 120))), rng.choice([1, 2, 5, 6, 16]), rng.choice([1, 3, 4, 7])
        assert winnow(t, k, w)[1].tolist() == brute(t, k, w)


def test_shared_passage_is_found():
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    for _ in range(50):
        same = text(M.GRAM + M.WINDOW - 1)
        assert set(winnow(text(99) + same + text(50))[0].tolist()) & set(winnow(text(3) + same + text(77))[0].tolist())


def test_likeness():
    a = winnow("some text that is long enough to have several windows of grams in it, and then more")[0]
    assert likeness(a, a) == 1.0 and likeness(a, a[:0]) == 0.0 and likeness(a[:0], a[:0]) == 1.0


def test_next_document(make, odd):
    got = edit_fingerprints(make(odd)).collect()
    order = sorted(((-(10**9) if i is None else i, t or "", i) for i, t, *_ in odd), reverse=True)
    want = []
    for n, (_, t, i) in enumerate(order):
        other = order[(n + 1) % len(order)][1]
        e = edited(t, other)
        h = winnow(t)[0]
        want.append(str((i, len(t), hashlib.sha256(e.encode()).hexdigest(), round(likeness(h, winnow(e)[0]), 9), round(likeness(h, winnow(other)[0]), 9))))
    assert sorted(str((r.id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9))) for r in got) == sorted(want)
    by = {}
    for r in got:
        by.setdefault((r.n_chars, r.n_chosen, r.fingerprint), r)
    assert len({r.fingerprint for r in got}) == len({t for _, t, _ in order})


def test_small(make):
    one = edit_fingerprints(make([(5, "abcdef")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
    assert edit_fingerprints(make([])).count() == 0 and fingerprint(make([])).count() == 0
    got = fingerprint(make([(1, "x" * 100), (2, None)])).collect()
    assert len(got[0].hashes) == len(got[0].positions) > 0 and got[1].fingerprint == ""
