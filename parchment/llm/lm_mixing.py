"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is coded as its lower-cased words in order, and one end. What training text holds of the last two words
(order 2), the last word (order 1) and the word alone (order 0) decides how a word is coded: for each order in turn a bit says
whether the context has this word as a successor, and after a yes the word's share of the context's count
names it. A word that no training text has is spelled, each bit of its bytes coded.

All bits are coded in one way. Several predictors look up, each by a hash of its own context, how
often the bit was 0 and 1 before. A gate picks a set of weights by which the predictions are combined on the logistic scale;
the weights are learned online, in the order of the text. A last stage refines the
probability adaptively. The bits of a text add up to its total, and over its bytes to bits per byte.

A document that was learned from is left out of all counts when it is scored: what it says itself tells nothing.

Counts of words, pairs and triples grow with the input and stay spread over the cluster. Texts are handled in chunks; a chunk asks for the
counts of its distinct contexts, in blobs of sorted hashes, one for each slice of the hashes, and gets them back in that order. A key that is frequent
everywhere is asked for once a chunk. The hashes of pairs and triples widen with the input, so that one in a
thousand shares its place at any size.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import Shared, crc_mod, text_of, trim

#: Spelling predictors: orders 1 to 4, and the word so far. Each has 2**bits slots; they hold how words are built, not which there are.
SPELL_BITS = (16, 18, 20, 21, 22)
#: Predictors of the bits that tell orders, of 2**10 slots each.
ORDER_BITS = (10, 10, 10, 10, 10)
GATES, BINS, CELLS = 64, 24, 256
#: Slots of one row of counts on its way; bytes whose bits are in memory at a time; bits of one online step.
BLOCK, STEP, ONLINE = 1 << 16, 1 << 15, 1 << 14
#: Tokens whose order bits are in memory at a time.
TOKENS = 1 << 17
#: Characters of a chunk, about, and bytes of text whose hashes make a slice.
CHARACTERS, SLICE = 4_000_000, 8_000_000
#: Bytes from which on a word is hashed on its own.
LONG = 256
#: Slots whose predictions are made at a time; bytes whose powers are.
SLOTS, NEAR = 1 << 18, 1 << 16
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_START, _END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_LETTERS = np.random.default_rng(1).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


# ---- bits: counts, mixing, refinement


@dataclass
class Model:
    bits: tuple[int, ...]  # 2**bits slots of each predictor
    ones: np.ndarray  # times the bit was 1, by slot
    seen: np.ndarray  # times at all, by slot
    weights: np.ndarray  # (GATES, predictors + 1)
    refined: np.ndarray  # (CELLS, BINS)

    def _table(self, less: int, *ones_less: int) -> tuple[np.ndarray, np.ndarray]:
        """Each slot's prediction on the logistic scale, and how often it was asked, by powers of 2 up to 7; less so many askings, and for each of ones_less so many ones, in turn."""
        ones, seen, k = self.ones, self.seen, len(ones_less)
        x, level = np.empty(k * len(seen), np.float32), np.empty(len(seen), np.uint8)
        for s in range(0, len(seen), SLOTS):
            part = slice(s, s + SLOTS)
            asked = np.maximum(seen[part].astype(np.float32) - less, np.float32(0))
            level[part] = np.minimum(7, np.log2(asked + 1)).astype(np.uint8)
            for i, n in enumerate(ones_less):
                own = np.clip(ones[part].astype(np.float32) - n, np.float32(0), asked)
                x[i::k][part] = np.where(asked > 0, np.log((own + np.float32(0.02)) / (asked - own + np.float32(0.02))), np.float32(0))
        return x, level

    @cached_property
    def plain(self) -> tuple[np.ndarray, np.ndarray]:
        return self._table(0, 0)

    @cached_property
    def left_out(self) -> tuple[np.ndarray, np.ndarray]:
        """As plain, with one bit taken out of each slot's counts: a 0 at even places, a 1 at odd ones."""
        return self._table(1, 0, 1)

    def __getstate__(self) -> tuple:
        """Only slots that were asked for travel."""
        at = np.flatnonzero(self.seen)
        return self.bits, len(self.seen), packed(np.diff(at, prepend=0)), packed(self.ones[at]), packed(self.seen[at]), self.weights, self.refined

    def __setstate__(self, state: tuple) -> None:
        self.bits, *self.sent, self.weights, self.refined = state

    def __getattr__(self, name: str) -> np.ndarray:
        """ones and seen of a model that has travelled: made when asked for, and not kept."""
        if name not in ("ones", "seen"):
            raise AttributeError(name)
        n, at, ones, seen = self.sent
        out, at, values = np.zeros(n, np.uint32), unpacked(at, 4), unpacked(ones if name == "ones" else seen, 4)
        np.cumsum(at, out=at)
        for s in range(0, len(at), SLOTS):
            out[at[s : s + SLOTS]] = values[s : s + SLOTS]
        return out

    @classmethod
    def blank(cls, bits: tuple[int, ...], ones: np.ndarray, seen: np.ndarray) -> Model:
        weights = np.full((GATES, len(bits) + 1), 0.3)
        weights[:, -1] = 0.0
        return cls(bits, ones, seen, weights, _blank())


@dataclass
class Bits:
    """Some bits in coding order: whose they are, their values, refinement cells, slots (predictors, bits) and gates."""

    owner: np.ndarray
    bit: np.ndarray
    cell: np.ndarray
    slots: np.ndarray
    gate: np.ndarray | None = None  # None: how often the last two predictors have been asked


def _blank() -> np.ndarray:
    return np.repeat(_squash((np.arange(BINS) + 0.5) * (24 / BINS) - 12)[None], CELLS, 0)


def _squash(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _bin(z: np.ndarray) -> np.ndarray:
    return np.clip(((z + 12) * (BINS / 24)).astype(np.int64), 0, BINS - 1)


def _inputs(model: Model, b: Bits, leave_out: bool) -> tuple[np.ndarray, np.ndarray]:
    """(predictions on the logistic scale and a constant, gates). A bit that is learned from is left out of its own counts."""
    table, level = model.left_out if leave_out else model.plain
    x = np.ones((len(b.slots) + 1, b.slots.shape[1]), np.float32)
    x[:-1] = table[2 * b.slots + b.bit] if leave_out else table[b.slots]
    if b.gate is not None:
        return x, b.gate
    return x, level[b.slots[-1]].astype(np.int64) * 8 + level[b.slots[-2]]


def _mixed(weights: np.ndarray, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
    z = np.zeros(len(gate), np.float32)
    for w, own in zip(weights.T.astype(np.float32), x, strict=True):
        z += w[gate] * own
    return z


def log10_probability(model: Model, steps: Iterator[Bits], owners: int) -> np.ndarray:
    """log10 of the probability of each owner's bits."""
    out, refined = np.zeros(owners), model.refined.ravel()
    for b in steps:
        x, gate = _inputs(model, b, False)
        z = _mixed(model.weights, x, gate)
        p = np.clip((_squash(z) + refined[b.cell * BINS + _bin(z)]) / 2, 1e-9, 1 - 1e-9)
        out += np.bincount(b.owner, np.log10(np.where(b.bit == 1, p, 1 - p)), owners)
    return out


def _count(bits: tuple[int, ...], steps: Iterator[Bits]) -> tuple[np.ndarray, np.ndarray]:
    """(ones, all) of the bits by slot."""
    both = np.zeros(sum(1 << b for b in bits), "<i8")  # all below, ones above
    for b in steps:
        add = 1 + (b.bit.astype(np.int64) << 32)
        for slots in b.slots:
            np.add.at(both, slots, add)
    halves = both.view("<u4")
    return halves[1::2], halves[0::2]


def _learn(model: Model, steps: Iterator[Bits]) -> tuple[np.ndarray, np.ndarray]:
    """Online steps in the order of the bits: (weights times bits then hits, bits then times), to be added over tasks.

    Each short run of bits makes one second-order step, with the curvature that has gathered so far; the curvature is
    taken from every fourth run, for four.
    """
    k1 = len(model.bits) + 1
    w, total, runs = model.weights.copy(), 0, 0
    hits, times = np.zeros(CELLS * BINS), np.zeros(CELLS * BINS)
    curve = np.repeat(np.eye(k1)[None] * 200.0, GATES, 0)
    for b in steps:
        x, gate = _inputs(model, b, True)
        found = np.empty(len(b.bit), np.float32)
        for s in range(0, len(b.bit), ONLINE):
            part = slice(s, s + ONLINE)
            xs, gs = x[:, part], gate[part]
            found[part] = z = _mixed(w, xs, gs)
            p = _squash(z)
            err = b.bit[part] - p
            slope = np.stack([np.bincount(gs, err * xs[i], GATES) for i in range(k1)], 1)
            if runs % 4 == 0:
                bend = 4 * np.maximum(p * (1 - p), 1e-4)
                for i in range(k1):
                    bent = bend * xs[i]
                    for j in range(i + 1):
                        add = np.bincount(gs, bent * xs[j], GATES)
                        curve[:, i, j] += add
                        if i != j:
                            curve[:, j, i] += add
            runs += 1
            w += np.linalg.solve(curve, slope[:, :, None])[:, :, 0]
        cell = b.cell * BINS + _bin(found)
        hits += np.bincount(cell, b.bit, CELLS * BINS)
        times += np.bincount(cell, minlength=CELLS * BINS)
        total += len(b.bit)
    return np.concatenate([w.ravel() * total, hits]), np.concatenate([np.full(w.size, float(total)), times])


def _blocks(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(block, data) of two arrays of one kind: places that are not zero, of BLOCK each, and their values."""
    kind = b"f" if a.dtype.kind == "f" else b"i"
    for s in range(0, len(a), BLOCK):
        at = np.flatnonzero(a[s : s + BLOCK] != 0) if kind == b"f" else np.flatnonzero(b[s : s + BLOCK])
        if kind == b"f":
            at = np.union1d(at, np.flatnonzero(b[s : s + BLOCK] != 0))
        if len(at):
            values = [x[s + at] for x in (a, b)]
            data = kind + (packed(values[0]) + packed(values[1]) if kind == b"i" else _zipped(np.concatenate(values).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([s // BLOCK], pa.int32()), pa.array([_framed(packed(np.diff(at, prepend=0))) + data], pa.binary())], ["block", "data"])


def _block(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, a, b) of a row of _blocks()."""
    at, rest = _unframed(data)
    at = np.cumsum(unpacked(at)).astype(np.int64)
    if rest[:1] == b"i":
        n = packed_size(rest[1:])
        return at, unpacked(rest[1 : 1 + n]).astype(np.int64), unpacked(rest[1 + n :]).astype(np.int64)
    both = np.frombuffer(_unzipped(rest[1:]), np.float64)
    return at, both[: len(at)], both[len(at) :]


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the data of each block; rows come sorted by block."""
    held: list[tuple] = []
    at = None

    def row() -> Iterator[pa.RecordBatch]:
        kind = held[0][1].dtype
        a, b = np.zeros(BLOCK, kind), np.zeros(BLOCK, kind)
        for places, x, y in held:
            a[places] += x
            b[places] += y
        for out in _blocks(a, b):
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), out.column(1)], ["block", "data"])

    for batch in batches:
        for block, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if block != at and held:
                yield from row()
                held = []
            at = block
            held.append(_block(data.as_py()))
            if len(held) > 16:  # memory stays that of few rows, however many tasks send
                kind = held[0][1].dtype
                a, b = np.zeros(BLOCK, kind), np.zeros(BLOCK, kind)
                for places, x, y in held:
                    a[places] += x
                    b[places] += y
                held = [(np.arange(BLOCK), a, b)]
    if held:
        yield from row()


def _trimmed(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """work, after which its worker gives back the memory it took."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        trim()

    return run


def _gathered(rows: DataFrame, n: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The two arrays of n, added over all tasks: they have a fixed size, and so has what reaches the driver."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = rows.repartition(parts, "block").sortWithinPartitions("block").mapInArrow(_trimmed(_summed), "block int, data binary").toArrow()
    a, b = np.zeros(n, kind), np.zeros(n, kind)
    for block, data in zip(found.column("block").to_pylist(), found.column("data"), strict=True):
        places, x, y = _block(data.as_py())
        a[block * BLOCK + places], b[block * BLOCK + places] = x, y
    return a, b


def trained(rows: DataFrame, bits: tuple[int, ...], steps: Callable[[Iterator[pa.RecordBatch]], Iterator[Bits]]) -> Model:
    """Counts over all rows first, then weights and refinement over all of them; steps makes bits of a task's rows."""
    spark, schema = rows.sparkSession, "block int, data binary"
    ones, seen = _gathered(rows.mapInArrow(_trimmed(lambda b: _blocks(*_count(bits, steps(b)))), schema), sum(1 << b for b in bits), np.int64)
    model = Model.blank(bits, np.minimum(ones, 2**32 - 1).astype(np.uint32), np.minimum(seen, 2**32 - 1).astype(np.uint32))
    shared = spark.sparkContext.broadcast(model)
    n = model.weights.size
    a, b = _gathered(rows.mapInArrow(_trimmed(lambda x: _blocks(*_learn(shared.value, steps(x)))), schema), n + CELLS * BINS, np.float64)
    shared.destroy()
    if b[:n].any():
        model.weights = (a[:n] / b[:n]).reshape(model.weights.shape)
    hits, times = a[n:].reshape(CELLS, BINS), b[n:].reshape(CELLS, BINS)
    model.refined = (hits + 50 * _blank()) / (times + 50)
    return model


# ---- spelling


def spelled(tokens: list[bytes]) -> Iterator[Bits]:
    """The bits of words, each with a closing space, highest first; the end, an empty word, is a line feed. Contexts lie within a word."""
    return _spelled(np.frombuffer(b" ".join([*tokens, b""]), np.uint8))


def _spelled(raw: np.ndarray) -> Iterator[Bits]:
    """As spelled(), of words that each have their closing space."""
    closes = raw == 32
    token = np.cumsum(closes) - closes
    sizes = np.diff(np.flatnonzero(closes), prepend=-1)
    place = np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    raw = np.where(closes & (place == 0), np.uint8(10), raw)
    contexts = _contexts(raw, place)
    first, shift = np.cumsum([0, *(1 << b for b in SPELL_BITS)]), np.arange(8)
    for s in range(0, len(raw), STEP):
        byte = raw[s : s + STEP].astype(np.int64)[:, None]
        known = (1 << shift) | (byte >> (8 - shift))
        with np.errstate(over="ignore"):
            h = (contexts[:, s : s + STEP, None] + known.astype(np.uint64)[None] * _B) * _A
            h = (h ^ (h >> np.uint64(29))) * _B
        slots = np.stack([(h[k] >> np.uint64(64 - b)).astype(np.int64).ravel() + first[k] for k, b in enumerate(SPELL_BITS)])
        yield Bits(np.repeat(token[s : s + STEP], 8), ((byte >> (7 - shift)) & 1).ravel(), known.ravel(), slots)


def _contexts(raw: np.ndarray, place: np.ndarray) -> np.ndarray:
    """(predictors, bytes) hashes of the contexts before each byte."""
    out = np.zeros((len(SPELL_BITS), len(raw)), np.uint64)
    byte, near = raw.astype(np.uint64) + np.uint64(1), np.zeros(len(raw), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, 5):
            back = np.zeros(len(raw), np.uint64)
            back[n:] = byte[:-n]
            near = near * np.uint64(257) + np.where(place >= n, back, np.uint64(0))
            out[n - 1] = near * _A + np.uint64(n)
        power = np.cumprod(np.full(int(place.max(initial=0)) + 1, _B, np.uint64))
        upto = np.cumsum(byte * power[place])
        before = np.concatenate([np.zeros(1, np.uint64), upto[:-1]])
        first = np.flatnonzero(place == 0)
        out[4] = (before - np.repeat(before[first], np.diff(np.append(first, len(raw))))) * _A + np.uint64(5)
    return out


def _spelling_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[Bits]:
    for batch in batches:
        for data in batch.column(0):
            yield from _spelled(np.frombuffer(_unzipped(data.as_py()), np.uint8))


# ---- orders: which context names a word


def levels(n: np.ndarray) -> np.ndarray:
    """0 to 7 for how often a context was seen: never, 1, 2, to 4, 8, 32, 256, more."""
    return np.searchsorted(np.array([1, 2, 3, 5, 9, 33, 257]), n, side="right")


def order_bits(states: list[np.ndarray]) -> Bits:
    """The bits that tell each token's order, text after text. A state is the order (0: spelled, 1: known word, 2 and 3: one and two words
    of context), plus 4 times the pair's level, plus 32 times the last word's level."""
    state = np.concatenate(states).astype(np.int64) if states else np.empty(0, np.int64)
    sizes = np.array([len(s) for s in states], np.int64)
    owner = np.repeat(np.arange(len(states)), sizes)
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    order, two, one = state & 3, (state >> 2) & 7, state >> 5
    at = np.arange(len(state))
    back = []
    for n in range(1, 5):
        prev = np.zeros(len(state), np.int64)
        prev[n:] = order[:-n]
        back.append(np.where(at - n >= start, prev, 0))
    # Tokens since the last one that two words of context didn't name.
    last = np.maximum.accumulate(np.where(order != 3, at, -1))
    run = np.minimum(np.concatenate([np.zeros(1, np.int64), (at - last)[:-1]])[: len(at)], at - start)
    run = np.minimum(15, np.where(run > 0, 1 + np.log2(np.maximum(run, 1)).astype(np.int64), 0))
    contexts = [two * 8 + one, back[0] * 64 + back[1] * 16 + back[2] * 4 + back[3], (back[0] * 4 + back[1]) * 8 + two, run * 8 + one, (back[0] * 8 + two) * 8 + one]
    asked = np.stack([two > 0, (one > 0) & (order != 3), order < 2], 1)
    bit = np.stack([order == 3, order == 2, order == 1], 1).astype(np.int64)
    kind = np.broadcast_to(np.arange(3), bit.shape)
    slots = np.stack([((k << 10) + kind * 256 + c[:, None])[asked] for k, c in enumerate(contexts)])
    cell = kind * 64 + (back[0] * 16 + back[1] * 4 + back[2])[:, None]
    gate = kind * 16 + run[:, None]
    whose = np.broadcast_to(owner[:, None], bit.shape)
    return Bits(whose[asked], bit[asked], cell[asked], slots, gate[asked])


def _portions(batch: pa.RecordBatch) -> Iterator[list[np.ndarray]]:
    """States of a batch's texts, of about TOKENS tokens at a time or of one longer text."""
    states = [np.frombuffer(x.as_buffer(), np.uint8) for x in batch.column("states")]
    part = np.cumsum([len(s) for s in states]) // TOKENS
    edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else []
    for s, e in zip(edges[:-1], edges[1:], strict=True):
        yield states[s:e]


def _order_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[Bits]:
    for batch in batches:
        yield from map(order_bits, _portions(batch))


# ---- numbers in few bytes


def _zipped(data: bytes) -> bytes:
    return struct.pack("<Q", len(data)) + pa.compress(data, codec="zstd", asbytes=True)


def _unzipped(data: bytes) -> bytes:
    return pa.decompress(data[8:], struct.unpack("<Q", data[:8])[0], codec="zstd", asbytes=True)


def _framed(data: bytes) -> bytes:
    return struct.pack("<Q", len(data)) + data


def _unframed(data: bytes) -> tuple[bytes, bytes]:
    n = 8 + struct.unpack("<Q", data[:8])[0]
    return data[8:n], data[n:]


def packed(x: np.ndarray) -> bytes:
    """Whole numbers from 0 on: byte by byte of equal rank, those of the highest rank last, compressed."""
    width = max(1, -(-int(x.max(initial=0)).bit_length() // 8))
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    data = pa.compress(planes.tobytes(), codec="zstd", asbytes=True)
    return struct.pack("<BQQ", width, len(x), len(data)) + data


def packed_size(data: bytes) -> int:
    return 17 + struct.unpack("<Q", data[9:17])[0]


def unpacked(data: bytes, wide: int = 8) -> np.ndarray:
    """The numbers of packed(), of so many bytes each; none may be wider."""
    width, n, size = struct.unpack("<BQQ", data[:17])
    out = np.zeros((n, wide), np.uint8)
    if n:
        out[:, :width] = np.frombuffer(pa.decompress(data[17 : 17 + size], width * n, codec="zstd", asbytes=True), np.uint8).reshape(width, n).T
    return out.reshape(-1).view(f"<u{wide}").astype(f"u{wide}", copy=False)


# ---- chunks and their counts


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def _powers(x: int, n: int) -> np.ndarray:
    """Powers 0 to n of a number, modulo 2**64."""
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, x, np.uint64))])


#: Of an odd number, and of its inverse modulo 2**64.
_ODD, _BACK = _powers(int(_A), NEAR), _powers(pow(int(_A), -1, 2**64), NEAR)


def _spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The places of all bytes of some spans, span after span."""
    sizes = ends - starts
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _distinct(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct names, a place of each, which of them is at each place), by a sort that need not be stable."""
    order = np.argsort(names)
    ordered = names[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    inverse = np.empty(len(names), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return ordered[new], order[new], inverse


class Chunk:
    """The tokens of some rows (id, train, text) in a row: words, A-Z in lower case, and after each text an end, an empty word."""

    def __init__(self, batch: pa.RecordBatch):
        texts = [t.as_py().encode("utf-8", "surrogatepass") for t in batch.column("text")]
        # A line feed stands before and after each text.
        raw = b"\n".join([b"", *texts, b""]).lower()
        self.raw = np.frombuffer(raw, np.uint8)
        space = _SPACE[self.raw]
        starts, stops = np.flatnonzero(space[:-1] & ~space[1:]) + 1, np.flatnonzero(~space[:-1] & space[1:]) + 1
        names = self._named(raw, starts, stops)
        edges = np.cumsum([0, *(len(t) + 1 for t in texts)])
        words = np.diff(np.searchsorted(starts, edges))
        self.ids, self.sizes = batch.column("id"), words + 1
        self.of = np.repeat(np.arange(len(texts)), self.sizes)
        self.first = np.cumsum(self.sizes) - self.sizes
        ends = self.first + words
        word = np.ones(len(self.of), bool)
        word[ends] = False
        self.names, self.starts, self.stops = np.full(len(word), _END), np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        self.names[word], self.starts[word], self.stops[word] = names, starts, stops
        self.train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
        self.learns = self.train[self.of]

    def _named(self, raw: bytes, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Names of words of 64 bits: sums of powers over random numbers of their bytes, mixed; of long words a hash that no pattern of letters can trick."""
        far, back = (_powers(int(x[NEAR]), len(self.raw) // NEAR) for x in (_ODD, _BACK))
        upto = np.zeros(len(self.raw) + 1, np.uint64)
        with np.errstate(over="ignore"):
            for k, s in enumerate(range(0, len(self.raw), NEAR)):
                own = _LETTERS[self.raw[s : s + NEAR]]
                own *= _ODD[: len(own)] * far[k]
                own[0] += upto[s]
                np.cumsum(own, out=upto[s + 1 : s + 1 + len(own)])
            names = _mix((upto[stops] - upto[starts]) * _BACK[starts % NEAR] * back[starts // NEAR] + (stops - starts).astype(np.uint64) * _B)
        for i in np.flatnonzero(stops - starts > LONG).tolist():
            names[i] = xxhash.xxh64_intdigest(raw[starts[i] : stops[i]])
        return names

    def words(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of the words at these tokens, each with a space after it; where each ends)."""
        starts, stops = self.starts[at], self.stops[at]
        out = np.full(int((stops - starts).sum()) + len(at), 32, np.uint8)
        upto = np.cumsum(stops - starts + 1)
        out[_spans(upto - 1 - (stops - starts), upto - 1)] = self.raw[_spans(starts, stops)]
        return out, upto

    def keys(self, bits: int) -> list[np.ndarray]:
        """Names of words (64 bits), and of pairs and triples that end at each word (bits)."""
        one, two = np.full(len(self.names), _START), np.full(len(self.names), _START)
        one[1:], two[2:] = self.names[:-1], self.names[:-2]
        one[self.first] = two[self.first] = _START
        second = self.first[self.sizes > 1] + 1
        two[second] = _START
        with np.errstate(over="ignore"):
            pair = _mix(self.names * _A + _mix(one))
            triple = _mix(self.names * _A + _mix(one + _mix(two) * _B))
        return [self.names, pair >> np.uint64(64 - bits), triple >> np.uint64(64 - bits)]


def _body(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unbody(data: bytes) -> pa.RecordBatch:
    return next(iter(pa.ipc.open_stream(data)))


def _bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, size, body) of about CHARACTERS characters, or of one longer text."""
    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        sizes = pc.add(pc.utf8_length(batch.column("text")), 1).to_numpy(zero_copy_only=False)
        mark = np.cumsum(sizes) // CHARACTERS
        edges = np.flatnonzero(np.r_[True, mark[1:] != mark[:-1], True]) if len(mark) else []
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            yield pa.RecordBatch.from_arrays([pa.array([(part << 32) + n], pa.int64()), pa.array([int(sizes[s:e].sum())], pa.int64()), pa.array([_body(batch.slice(int(s), int(e - s)))], pa.binary())], ["chunk", "size", "body"])
            n += 1


_ASKED = "kind int, slice int, chunk long, keys binary, counts binary, words binary"
_REPLY = "chunk long, kind int, slice int, payload binary, tokens long, types long"


def _names_of(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _ask(batches: Iterator[pa.RecordBatch], bits: int, deep: int) -> Iterator[pa.RecordBatch]:
    """A chunk's distinct words, pairs and triples with their counts in its training texts, a row for each of 2**deep slices."""
    for batch in batches:
        for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("body"), strict=True):
            c = Chunk(_unbody(data.as_py()))
            for kind, names in enumerate(c.keys(bits)):
                if kind == 0:
                    keys, at, inverse = _distinct(names)
                    counts = np.bincount(inverse, c.learns, len(keys)).astype(np.int64)
                    words, upto = c.words(at)
                    upto = np.concatenate([[0], upto])
                else:  # the lowest bit says whether the place is learned from
                    every = np.sort((names << np.uint64(1)) | c.learns)
                    new = np.flatnonzero(np.r_[True, (every[1:] ^ every[:-1]) > 1])
                    keys, counts = every[new] >> np.uint64(1), np.add.reduceat((every & np.uint64(1)).astype(np.int64), new)
                of = keys >> np.uint64((64 if kind == 0 else bits) - deep) if deep else np.zeros(len(keys), np.uint64)
                edges = np.searchsorted(of, np.arange((1 << deep) + 1, dtype=np.uint64))
                rows = []
                for i in range(1 << deep):
                    s, e = int(edges[i]), int(edges[i + 1])
                    if s < e:
                        own = _zipped(words[upto[s] : upto[e]].tobytes()) if kind == 0 else None
                        rows.append((kind, i, chunk, packed(np.diff(keys[s:e], prepend=np.uint64(0))), packed(counts[s:e]), own))
                types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], _names_of(_ASKED))


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts over all chunks, for each chunk in the order of its keys; rows come sorted by kind and slice. Of words, also the distinct ones that were learned, under chunk -1."""
    held: list[dict] = []

    def slice_done() -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            keys = [np.cumsum(unpacked(r["keys"]), dtype=np.uint64) for r in held]
        flat, n = np.concatenate(keys), np.concatenate([unpacked(r["counts"]) for r in held])
        order = np.argsort(flat)
        ordered = flat[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]]
        total = np.add.reduceat(n[order], np.flatnonzero(new))
        each = np.empty(len(flat), np.uint64)
        each[order] = total[np.cumsum(new) - 1]
        edges = np.cumsum([0, *map(len, keys)])
        kind, at = held[0]["kind"], held[0]["slice"]
        rows = [(r["chunk"], kind, at, packed(each[s:e]), 0, 0) for r, s, e in zip(held, edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        if kind == 0 and total.any():
            words = np.frombuffer(b"".join(_unzipped(r["words"]) for r in held), np.uint8)
            stops = np.flatnonzero(words == 32) + 1
            firsts = order[new][total > 0]
            known = words[_spans(np.concatenate([[0], stops[:-1]])[firsts], stops[firsts])]
            rows.append((-1, kind, at, _zipped(known.tobytes()), int(total.sum()), len(firsts)))
        types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], _names_of(_REPLY))

    for batch in batches:
        for r in batch.to_pylist():
            if held and (r["kind"], r["slice"]) != (held[0]["kind"], held[0]["slice"]):
                yield from slice_done()
                held = []
            held.append(r)
    if held:
        yield from slice_done()


def _state(c: Chunk, bits: int, answers: list[np.ndarray], n: int, v: int, spelling: Model) -> list[pa.Array]:
    """Columns of a chunk's rows: n_tokens, n_known, base, fixed, bytes, states. fixed adds the shares that name words, and the bits that spell them."""
    counts, places = [], None
    for names, reply in zip(c.keys(bits), answers, strict=True):
        _, at, inverse = _distinct(names)
        counts.append(reply.astype(np.int64)[inverse])
        places = places or (at, inverse)
    word, pair, triple = (x - c.learns for x in counts)
    begins = np.zeros(len(word), bool)
    begins[c.first] = True
    # How often the contexts were seen: the pair, and the last word, that end before each token.
    two, one = (np.where(begins, 0, np.concatenate([np.zeros(1, np.int64), x[:-1]])) for x in (pair, word))
    order = np.where((two > 0) & (triple > 0), 3, np.where((one > 0) & (pair > 0), 2, np.where(word > 0, 1, 0)))
    share = np.select([order == 3, order == 2, order == 1], [triple / np.maximum(two, 1), pair / np.maximum(one, 1), word / np.maximum(n - c.learns, 1)], 1.0)
    fixed = np.log10(share)
    # Each distinct word is spelled once.
    at, inverse = places
    unknown = np.unique(inverse[order == 0])
    cost = np.zeros(len(at))
    if len(unknown):
        cost[unknown] = log10_probability(spelling, _spelled(c.words(at[unknown])[0]), len(unknown))
    fixed += np.where(order == 0, cost[inverse], 0.0)
    base = np.log10((counts[0] + 1) / (n + v + 1))
    sizes, docs = c.stops - c.starts + 1, len(c.sizes)
    add = lambda x: np.bincount(c.of, x, docs)
    states = (order + 4 * levels(two) + 32 * levels(one)).astype(np.uint8).tobytes()
    states = [states[s : s + k] for s, k in zip(c.first.tolist(), c.sizes.tolist(), strict=True)]
    longs = [pa.array(x.astype(np.int64), pa.int64()) for x in (c.sizes, add(counts[0] > 0))]
    return [*longs, pa.array(add(base), pa.float64()), pa.array(add(fixed), pa.float64()), pa.array(add(sizes).astype(np.int64), pa.int64()), pa.array(states, pa.binary())]


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Rows with crc32(id as text) mod 7 = 2 are scored but not learned from; those with a null id are learned from. Null
    texts are empty and hold the end alone. Repeated rows score alike. Without training tokens the base counts none and the
    model is uniform. An empty table gives an empty result; other columns are not read. Memory grows with the longest text.
    """
    spark = docs.sparkSession
    shared, parts = Shared(spark, "lm"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    learns = F.coalesce(crc_mod("id", 7) != 2, F.lit(True))
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).select("id", learns.alias("train"), "text")
    id_type = rows.schema["id"].dataType.simpleString()
    chunks = shared.save(rows.mapInArrow(_trimmed(_bundle), "chunk long, size long, body binary"), "chunks")
    number, size = chunks.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    bits = min(62, max(16, int(size).bit_length() + 8))
    deep = min(bits - 1, max(0, int(size) // SLICE).bit_length())
    asked = chunks.select("chunk", "body").mapInArrow(_trimmed(lambda b: _ask(b, bits, deep)), _ASKED)
    asked = asked.repartition(max(parts, 1 << deep), "kind", "slice").sortWithinPartitions("kind", "slice", "chunk")
    replies = shared.save(asked.mapInArrow(_trimmed(_answer), _REPLY), "replies")
    learned = replies.where("chunk = -1")
    total, distinct = (int(x) for x in learned.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first())
    spelling = spark.sparkContext.broadcast(trained(learned.select("payload"), SPELL_BITS, _spelling_steps))

    schema = f"id {id_type}, train boolean, n_tokens long, n_known long, base_score double, fixed double, bytes long, states binary"

    def state(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers: list[list[np.ndarray]] = [[], [], []]
        for batch in batches:
            for kind, data in zip(batch.column("kind").to_pylist(), batch.column("payload"), strict=True):
                if kind < 3:
                    answers[kind].append(unpacked(data.as_py()))
                    continue
                c = Chunk(_unbody(data.as_py()))  # comes after its answers
                columns = _state(c, bits, [np.concatenate(a) for a in answers], total, distinct, spelling.value)
                answers = [[], [], []]
                yield pa.RecordBatch.from_arrays([c.ids, pa.array(c.train), *columns], _names_of(schema))

    both = replies.where("chunk >= 0").select("chunk", "kind", "slice", "payload").unionByName(chunks.select("chunk", F.lit(9).alias("kind"), F.lit(0).alias("slice"), F.col("body").alias("payload")))
    both = both.repartition(max(parts, -(-int(number) // 2)), "chunk").sortWithinPartitions("chunk", "kind", "slice")
    states = shared.save(both.select("kind", "payload").mapInArrow(_trimmed(state), schema), "states")
    spelling.destroy()
    orders = spark.sparkContext.broadcast(trained(states.where("train").select("states"), ORDER_BITS, _order_steps))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                own = np.concatenate([log10_probability(orders.value, iter([order_bits(p)]), len(p)) for p in _portions(batch)])
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(own, pa.float64())], [*batch.schema.names[:-1], "own"])

    found = states.mapInArrow(_trimmed(scored), schema.removesuffix("states binary") + "own double").withColumn("score", F.col("fixed") + F.col("own"))
    return found.select(
        "id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        (-F.col("score") / F.log10(F.lit(2.0)) / F.col("bytes")).alias("bits_per_byte"),
    )
