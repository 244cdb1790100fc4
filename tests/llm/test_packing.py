import random
import zlib
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from parchment.llm.packing import TokenBytes, best_fit, cut, pack_documents, placed

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("text", ["", " ", "a  b \t c\n\n d\x1ce \x1c !\x1c x　y  ", "\x85a's 'll don't  x", " x x\n", "Καλημέρα abcΚα abc, abc1 abc'sx don'tyou naïve é́", "日本語abc abc日本", "<|endoftext|> a <|endoftext|>"])
def test_remembered_segments_give_the_same_ids(text):
    ids = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert TokenBytes.get(PATH)(text) == array("I", ids).tobytes()


def test_cut():
    assert cut(1, 8) == [(0, 1)] and cut(8, 8) == [(0, 8)] and cut(9, 8) == [(0, 1), (1, 8)] and cut(17, 8) == [(0, 1), (1, 8), (9, 8)]


@pytest.mark.parametrize("open_bins", [1, 4, 64])
def test_best_fit_against_plain_search(open_bins):
    rng = random.Random(3)
    lengths = [rng.randint(1, 50) for _ in range(500)]
    free, want, last = {}, [], 0
    for n in lengths:
        fits = [f for f in free.values() if f >= n]
        if fits:
            b = max((b for b, f in free.items() if f == min(fits)), key=lambda b: order.index(b))
        else:
            if len(free) >= open_bins:
                low = min(free.values())
                del free[max((b for b, f in free.items() if f == low), key=lambda b: order.index(b))]
            b, free[last], last = last, 50, last + 1
            order = [] if b == 0 else order
        want.append((b, 50 - free[b]))
        free[b] -= n
        order = [x for x in order if x != b] + [b]
        if not free[b]:
            del free[b]
    assert list(best_fit(iter(lengths), 50, open_bins)) == want


def test_documents(make, odd):
    got = pack_documents(make(odd), PATH, 64).collect()
    tok = Tokenizer.from_file(PATH)
    want = []
    for i, text, *_ in odd:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        want += [str((i, k, s, n, zlib.crc32(array("I", ids[s : s + n]).tobytes()))) for k, (s, n) in enumerate(cut(len(ids), 64))]
    assert sorted(str((r.id, r.piece, r.start, r.length, r.ids_crc32)) for r in got) == sorted(want)
    bins = {}
    for r in sorted(got, key=lambda r: r.offset):
        assert bins.get(r.sequence_id, 0) == r.offset
        bins[r.sequence_id] = r.offset + r.length
    assert max(bins.values()) <= 64 and len(bins) <= 1.1 * sum(bins.values()) / 64 + 2


def test_empty(make):
    assert pack_documents(make([]), PATH).count() == 0


def test_full_pieces_close_no_bin():
    lengths = [30, 50, 20, 50, 40, 10]
    got = list(placed(iter(lengths), 50, 1))
    (a, b, c, d, e, f) = got
    assert a[0] == c[0] and c[1] == 30 and e[0] == f[0] and f[1] == 40 and b[1] == d[1] == 0
    assert len({x for x, _ in got}) == 4 and len({x for x, _ in best_fit(iter(lengths), 50, 1)}) > 4


def test_workers_remember_few_segments():
    ids, asked = TokenBytes(PATH), []
    ids.known.find = lambda segment: asked.append(segment) or b""
    texts = [" ".join(["often", *(f"w{n}" for n in range(s, s + 1000)), "x" * 65]) for s in range(0, 700_000, 1000)]
    most = 0
    for text in texts:
        ids(" " + text.translate(str.maketrans("0123456789", "abcdefghij")))
        most = max(most, len(ids.known) + len(ids.known.before))
    assert most < 610_000 and asked.count(" often") == 1
    assert not any(len(s) > 64 for s in [*ids.known, *ids.known.before])
