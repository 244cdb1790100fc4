"""Near copies against all pairs, compared in plain Python."""

import random

import corpus_pipeline as P
from parchment.llm import minhash, simhash

WORDS = [f"w{i}" for i in range(3000)]


def grams(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def survivors(rows):
    """The smallest id of each component over all pairs with Jaccard similarity 0.8 or more."""
    sets, up = [grams(t or "") for _, t in rows], list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                up[top(i)] = top(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), key), key)
    return sorted(least.values())


def copies(rng, n=12):
    """Texts with copies that differ in some words or have further ones: similarities on both sides of 0.8, and chains."""
    texts = []
    for _ in range(n):
        text = [rng.choice(WORDS) for _ in range(rng.choice([30, 90, 200]))]
        texts.append(text)
        for _ in range(6):
            text = list(rng.choice([text, texts[-1]]))
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                text[rng.randrange(len(text))] = rng.choice(WORDS)
            texts.append(text + [rng.choice(WORDS) for _ in range(rng.choice([0, 0, 3, 8]))])
    rng.shuffle(texts)
    return list(enumerate(map(" ".join, texts)))


def test_near_stage_against_all_pairs(make, spark):
    rows = copies(random.Random(3))
    want = survivors(rows)
    assert 12 < len(want) < len(rows) - 20
    assert sorted(r.doc_id for r in P.near(spark, make(rows), "").collect()) == want


def test_strays_of_a_large_bucket(make, spark, monkeypatch):
    """One band of one hash puts nearly all texts into a few buckets: what stars don't link, pairs do."""
    monkeypatch.setattr(minhash, "bands", lambda sets: (minhash.np.arange(2, dtype="int64")))
    rows = copies(random.Random(4), 5)
    assert sorted(r.doc_id for r in minhash.near_copies(make(rows)).collect()) == survivors(rows)


def test_fingerprints_are_the_first_candidates(make, spark, monkeypatch):
    """Without any MinHash bucket, copies whose fingerprints are near still meet at anchors, and the sets decide."""
    monkeypatch.setattr(minhash, "bands", lambda sets: minhash.np.random.default_rng().integers(0, 2**62, 2))
    rng = random.Random(5)
    rows = []
    for i in range(8):
        text = [rng.choice(WORDS) for _ in range(400)]
        # One more word changes one shingle of 397; the same words in another case change none.
        rows += [(10 * i, " ".join(text)), (10 * i + 1, " ".join([*text, "more"])), (10 * i + 2, " ".join(text).upper())]
    # One bit set in all three shingles of one, in two of three of the other: equal fingerprints are no proof.
    monkeypatch.setattr(minhash, "majority", lambda counts, n: 7 if n < 20 else simhash.majority(counts, n), raising=False)
    rows += [(900, "a b c d e f g"), (901, "h i j k l m n")]
    got = sorted(r.doc_id for r in P.near(spark, make(rows), "").collect())
    assert survivors(rows) == [0, 10, 20, 30, 40, 50, 60, 70, 900, 901] and {900, 901} <= set(got)
    assert len(got) <= 12 and set(survivors(rows)) <= set(got)


def test_odd(make, odd):
    docs = make(odd)
    out = minhash.near_copies(docs)
    assert out.columns == docs.columns and minhash.near_copies(docs.limit(0)).count() == 0
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert len(got) == len(set(got)) and sorted(i for i, _ in got if i is not None) == [1, 3, 3, 4, 8, 9, 10, 11] and (None, "no id here") in got
