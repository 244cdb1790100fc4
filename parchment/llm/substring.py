"""Substring deduplication by recompression.

A document's words are symbols, named by their hashes. Each round replaces runs of one symbol
and then pairs of neighbours, the left one from one half of the alphabet and the
right one from the other, by new symbols; a symbol's name is a hash of what it stands for, so it is the same in
every document without any exchange. Whether two neighbours join depends on them alone: equal
substrings get the same symbols inside, all but a bounded margin at both ends.

Two levels serve. After two rounds of pairs symbols span at most four words, and any
WINDOW equal words hold a whole symbol at least three words from either end. Of these each window chooses the one with the smallest name, and names it by its words with three
more on either side: equal windows choose equal phrases, wherever they stand. A phrase that other
documents have too reveals where windows can repeat. At high levels symbols span whole passages, which are named
globally by 128 bits of a cryptographic hash of their words; one
that a smaller document has too, word for word, covers all of its words at once, and windows
inside need no look of their own. The remaining windows are compared by 128-bit
names over all documents, which verifies them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import Shared, text_of

#: Words of a window; margin of the two low rounds; words between the margins.
WINDOW, MARGIN = 13, 3
#: Rounds to the high level, whose symbols span about 75 words.
HIGH = 15
#: Characters of text whose symbols are in memory at a time.
CHARACTERS = 2_000_000
#: Bytes whose words are named at a time, about, and the bytes of words beyond which a word is named by a hash of its own.
BYTES, LONG = 1 << 20, 32
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_N1, _N2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_FAR = np.uint64(2**64 - 1)
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_LETTERS = np.random.default_rng(23).integers(0, 1 << 64, 256, np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _N1
    x = (x ^ (x >> np.uint64(29))) * _N2
    return x ^ (x >> np.uint64(32))


def names_of(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Names of words of 64 bits: sums of powers over random numbers of their bytes, mixed; of long words a hash that no pattern of letters can trick."""
    out = np.empty(len(starts), np.uint64)
    edges = np.flatnonzero(np.r_[True, np.diff(starts // BYTES) != 0, True]) if len(starts) else []
    for i, j in zip(edges[:-1], edges[1:], strict=True):
        s = starts[i:j] - starts[i]
        e = np.minimum(ends[i:j] - starts[i], s + LONG)
        data = flat[starts[i] : starts[i] + e[-1]]
        power, back = _power(max(len(data), BYTES), _M1)
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTERS[data] * power[: len(data)])])
        out[i:j] = _mix((upto[e] - upto[s]) * back[s] + (e - s).astype(np.uint64) * _M2)
    for i in np.flatnonzero(ends - starts > LONG).tolist():
        out[i] = xxhash.xxh64_intdigest(flat[starts[i] : ends[i]])
    return out


@dataclass
class Symbols:
    """Symbols of several documents in a row: name, first word, document."""

    names: np.ndarray
    starts: np.ndarray
    of: np.ndarray

    def pairs(self, n: int) -> "Symbols":
        """A symbol joins the next of its document if round n puts it left and the next right."""
        side = _mix(self.names + np.uint64(n) * _M2) >> np.uint64(63)
        joins = (side[:-1] == 0) & (side[1:] == 1) & (self.of[:-1] == self.of[1:])
        out = self.names.copy()
        out[:-1][joins] = _mix(self.names[:-1][joins] * _M1 + _mix(self.names[1:][joins] + np.uint64(n)))
        stay = np.ones(len(out), bool)
        stay[1:] = ~joins
        return Symbols(out[stay], self.starts[stay], self.of[stay])

    def runs(self) -> "Symbols":
        """Runs of one symbol become a symbol named by it and the run's length."""
        new = np.ones(len(self.names), bool)
        new[1:] = (self.names[1:] != self.names[:-1]) | (self.of[1:] != self.of[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(new)))
        out = self.names[first]
        many = count > 1
        out[many] = _mix(out[many] * _M2 + count[many].astype(np.uint64))
        return Symbols(out, self.starts[first], self.of[first])

    def ends(self, n: int) -> np.ndarray:
        return np.append(self.starts, n)[1:]


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int, seed: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of an odd number, and of its inverse modulo 2**64."""
    base = int(seed) | 1
    if len(_powers.get(base, ((),))[0]) <= n:
        _powers[base] = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, x, np.uint64))]) for x in (base, pow(base, -1, 2**64)))
    return _powers[base]


class Texts:
    """Words of several documents in a row, their names, and what recompression makes of them."""

    def __init__(self, texts: list[str], window: int = WINDOW):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
        space = _SPACE[data]
        # All words, with one space after each.
        stays = ~space
        stays[1:] |= ~space[:-1]
        self.flat = np.where(space, np.uint8(32), data)[stays]
        self.ends = np.flatnonzero(self.flat == 32)  # of words, their space excluded
        self.starts = np.concatenate([np.zeros(1, np.int64), self.ends + 1])[:-1]
        begins = stays & ~space
        begins[1:] &= space[:-1]
        self.window = window
        upto = np.searchsorted(np.flatnonzero(begins), np.cumsum([0, *(len(t) + 1 for t in raw)]))
        self.counts = np.diff(upto).astype(np.int64)
        self.names = names_of(self.flat, self.starts, self.ends)
        self.n = len(self.names)
        self.of = np.repeat(np.arange(len(raw)), self.counts)
        self.last = np.cumsum(self.counts)  # one past each document's last word
        self.first = self.last - self.counts
        self._upto: dict[int, np.ndarray] = {}

    def spans(self, starts: np.ndarray, ends: np.ndarray, seed: np.uint64) -> np.ndarray:
        """Hashes of the words starts..ends (ends excluded), by prefix sums of powers; equal words, equal hashes."""
        power, back = _power(self.n, seed)
        if int(seed) not in self._upto:
            self._upto[int(seed)] = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(self.names + seed) * power[: self.n])])
        upto = self._upto[int(seed)]
        return _mix((upto[ends] - upto[starts]) * back[starts] + (ends - starts).astype(np.uint64) * _M1)

    def levels(self) -> tuple[Symbols, Symbols]:
        """The low level, two rounds of pairs, and the high one, with runs."""
        low = Symbols(self.names, np.arange(self.n), self.of).pairs(1).pairs(2)
        top = low
        for k in range(3, HIGH + 1):
            top = top.runs().pairs(k)
        return low, top

    def phrases(self, low: Symbols) -> np.ndarray:
        """The name of the phrase that the window from each word on chooses; no window, no name."""
        starts, ends = low.starts, low.ends(self.n)
        fits = (starts - MARGIN >= self.first[low.of]) & (ends + MARGIN <= self.last[low.of])
        s, e = starts[fits], ends[fits]
        names = self.spans(s - MARGIN, e + MARGIN, _M1)
        inner = self.window - 2 * MARGIN
        best = np.full(self.n + self.window, _FAR, np.uint64)
        value = np.empty(self.n + self.window, np.uint64)
        for size in range(1, 5):
            own = e - s == size
            value[:] = _FAR
            value[s[own]] = names[own]
            for at in range(MARGIN, MARGIN + inner - size + 1):
                np.minimum(best[: self.n], value[at : at + self.n], out=best[: self.n])
        best = best[: self.n]
        best[np.arange(self.n) + self.window > self.last[self.of]] = _FAR
        return best

    def passages(self, top: Symbols, of_these: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(name, first word, end, document) of high-level symbols of at least a window and of whole documents, by document.

        A name is a row of two 64-bit numbers, which verify the words: they come from a cryptographic hash of the words themselves.
        """
        ends, wanted = top.ends(self.n), self.counts >= self.window
        if of_these is not None:
            wanted &= of_these
        long, whole = (ends - top.starts >= self.window) & wanted[top.of], np.flatnonzero(wanted)
        s, e, of = np.r_[top.starts[long], self.first[whole]], np.r_[ends[long], self.last[whole]], np.r_[top.of[long], whole]
        order = np.argsort(of, kind="stable")
        s, e, of = s[order], e[order], of[order]
        flat = memoryview(self.flat)
        digests = [hashlib.blake2b(flat[a:b], digest_size=16).digest() for a, b in zip(self.starts[s].tolist(), self.ends[e - 1].tolist(), strict=True)]
        return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2).astype(np.uint64), s, e, of

    def without(self, covered: np.ndarray) -> list[bytes]:
        """Each document's words but those covered, joined by one space."""
        sizes = self.ends - self.starts + 1
        flat = self.flat[np.repeat(~covered, sizes)].tobytes()
        upto = np.cumsum(np.r_[0, np.bincount(self.of, np.where(covered, 0, sizes), len(self.counts))]).astype(np.int64).tolist()
        return [flat[a : max(a, b - 1)] for a, b in zip(upto[:-1], upto[1:], strict=True)]

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit names of the windows that start at the words `at`."""
        return self.spans(at, at + self.window, _M2), self.spans(at, at + self.window, _N1)

    def judge(self, low: list[np.ndarray], high: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(words covered by passages, first words of the windows still to judge), given each document's shared names."""
        if not any(map(len, low)) and not any(map(len, high)):
            return np.zeros(self.n, bool), np.empty(0, np.int64)
        lows, top = self.levels()
        name, s, e, of = self.passages(top, np.array([len(x) > 0 for x in high], bool))
        hit = among(name[:, 0], of, high)
        s, e = s[hit], e[hit]
        best = self.phrases(lows)
        open_ = (best != _FAR) & among(best, self.of, low) & ~cover(self.n, s, e - self.window + 1)
        return cover(self.n, s, e), np.flatnonzero(open_)


def among(names: np.ndarray, of: np.ndarray, lists: list[np.ndarray]) -> np.ndarray:
    """Which names are in the list of their document."""
    own = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    flat = np.concatenate(lists).view(np.uint64) if len(own) else np.empty(0, np.uint64)
    tag = lambda n, d: _mix(n + _mix(d.astype(np.uint64) + _M1))
    return np.isin(tag(names, of), tag(flat, own))


def cover(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n words lie in any of the spans."""
    edge = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(ends, minlength=n + 1)[: n + 1]
    return np.cumsum(edge)[:n] > 0


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64), pa.int64())


def _lists(names: np.ndarray, of: np.ndarray, n: int) -> pa.Array:
    """Names, which come by document, as a list a document."""
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(of, minlength=n))], pa.int32()), _longs(names))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about CHARACTERS characters of text, or of one longer text."""
    for batch in batches:
        sizes = pc.utf8_length(batch.column("text")).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // CHARACTERS
        edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else []
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            yield batch.slice(int(s), int(e - s))


def _arrays(column: pa.Array) -> list[np.ndarray]:
    return [np.empty(0, np.int64) if x.as_py() is None else x.values.to_numpy() for x in column]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256, kept.

    Each word that a window covers whose words also start a window in a document with a smaller id is removed; windows
    are judged on the input. kept holds the kept words joined by one space. Ids must be integers; a null id counts
    as larger than all others. Rows that share an id, repeated rows among them, never remove each other's words. Null texts have no words; texts
    with fewer words than a window lose none. An empty table gives an empty result; other columns are not read. Memory grows with the longest text.
    """
    if window != WINDOW:
        raise ValueError(f"the margins are made for windows of {WINDOW} words")
    spark = docs.sparkSession
    shared = Shared(spark, "substring")
    big = 2**63 - 1
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(big)).alias("key"), text_of(text_col).alias("text"))
    # Rows without an id share their key; their lists are told apart by text, so that none gathers what all of them have.
    rows = rows.select("id", "key", F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(F.lit(0)).alias("sub"), "text")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            with np.errstate(over="ignore"):
                t = Texts(batch.column("text").to_pylist())
                low, top = t.levels()
                best = t.phrases(low)
                new = best != _FAR
                new[1:] &= (best[1:] != best[:-1]) | (t.of[1:] != t.of[:-1])
                high, _, _, of = t.passages(top)
            names = [_lists(best[new], t.of[new], len(batch)), *(_lists(high[:, i], of, len(batch)) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("sub"), *names], ["key", "sub", "low", "high", "more"])

    named = shared.save(rows.select("key", "sub", "text").mapInArrow(name, "key long, sub long, low array<long>, high array<long>, more array<long>"), "named")
    # Low names have 64 bits, since what they find is compared later, and 0 as the rest; high ones have 128.
    low = F.transform("low", lambda n: F.struct(n.alias("name"), F.lit(0).cast("long").alias("more")))
    high = F.zip_with("high", "more", lambda n, m: F.struct(n.alias("name"), m.alias("more")))
    listed = named.select("key", "sub", F.explode(F.concat(low, high)).alias("s")).select("key", "sub", "s.name", "s.more")
    # Names that two documents have; partial results meet, not rows.
    common = listed.groupBy("name", "more").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least < most")
    common = shared.save(common.select("name", "more", "least"), "common")
    shared.done()
    # For each document: shared phrases, and passages that a smaller document has.
    found = listed.join(common, ["name", "more"]).where("more = 0 OR least < key")
    found = found.groupBy("key", "sub").agg(F.collect_set(F.when(F.col("more") == 0, F.col("name"))).alias("low"), F.collect_set(F.when(F.col("more") != 0, F.col("name"))).alias("high"))
    found = shared.save(found.withColumnsRenamed({"key": "f_key", "sub": "f_sub"}), "found")
    shared.done("named", "common")
    touched = rows.join(found, (F.col("key") == F.col("f_key")) & (F.col("sub") == F.col("f_sub")), "left").drop("f_key", "f_sub")

    def open_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            with np.errstate(over="ignore"):
                t = Texts(batch.column("text").to_pylist())
                _, at = t.judge(_arrays(batch.column("low")), _arrays(batch.column("high")))
                a, b = t.windows(at)
                # Each window of a document once; they need not meet for that.
                of = t.of[at]
                order = np.argsort(_mix(a + of.astype(np.uint64) * _M1))
                new = np.ones(len(at), bool)
                new[1:] = (np.diff(of[order]) != 0) | (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
                once = np.sort(order[new])
                at, a, b = at[once], a[once], b[once]
            keys = [pa.array(batch.column(c).to_numpy(zero_copy_only=False)[t.of[at]], pa.int64()) for c in ("key", "sub")]
            yield pa.RecordBatch.from_arrays([*keys, _longs(a), _longs(b)], ["key", "sub", "a", "b"])

    judged = shared.save(touched.where("low IS NOT NULL").select("key", "sub", "text", "low", "high").mapInArrow(open_windows, "key long, sub long, a long, b long"), "windows")
    least = judged.groupBy("a", "b").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least < most").drop("most")
    shared.done()
    least = shared.save(least, "least")
    shared.done()
    repeated = judged.join(least, ["a", "b"]).where("least < key").groupBy("key", "sub").agg(F.collect_set("a").alias("again"))
    repeated = shared.save(repeated.withColumnsRenamed({"key": "r_key", "sub": "r_sub"}), "repeated")
    shared.done("windows", "least")
    last = touched.join(repeated, (F.col("key") == F.col("r_key")) & (F.col("sub") == F.col("r_sub")), "left").drop("r_key", "r_sub")

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words long, n_removed long, kept_sha256 string, kept string"

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            with np.errstate(over="ignore"):
                t = Texts(batch.column("text").to_pylist())
                covered, at = t.judge(_arrays(batch.column("low")), _arrays(batch.column("high")))
                at = at[among(t.windows(at)[0], t.of[at], _arrays(batch.column("again")))]
                covered |= cover(t.n, at, at + t.window)
            gone = np.bincount(t.of[covered], minlength=len(batch))
            kept = t.without(covered)
            sha = [hashlib.sha256(k).hexdigest() for k in kept]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(t.counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary()).cast(pa.string())], [x.split()[0] for x in schema.split(", ")])

    return last.select("id", "text", "low", "high", "again").mapInArrow(remove, schema)
