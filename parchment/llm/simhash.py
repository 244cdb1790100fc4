"""SimHash near-duplicates by anchor-point covering.

The anchors are the words of a covering code of all 64-bit strings: the product of
four perfect cyclic codes, two Golay codes of 23 bits (radius 3), a Hamming code of 15 bits
(radius 1) and a repetition code of 3 bits (radius 1). Every string lies within 8 bits of its anchor, the
word it decodes to, and 2**36 anchors keep their groups apart.

Two fingerprints that differ in t = 2r bits have a midpoint within r bits of each.
A fingerprint is therefore replicated to the anchors of all strings within r bits of it: these are
the anchors within covering radius plus threshold that can matter. Fingerprints
that share an anchor are compared there. Copies of one fingerprint are one row throughout.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parchment.llm.common import WORD, Shared, text_of, without
from parchment.llm.graph import connected_components

_WORD = re.compile(WORD.encode())
#: (bits, generator polynomial, radius) of each perfect cyclic code.
CODES = ((23, 0b110001110101, 3), (23, 0b110001110101, 3), (15, 0b10011, 1), (3, 0b111, 1))
#: Up to this many fingerprints of one anchor are compared pair by pair; up to the next
#: number, by their midpoints in memory; beyond, by a shuffle on midpoints.
SMALL, LARGE = 16, 4096
#: Shingles hashed at a time.
STEP = 1 << 18


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), STEP):
        part = h[at : at + STEP].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return counts


def majority(counts: np.ndarray, n: int) -> int:
    """64 bits; each is 1 if over half of n hashes have it."""
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "little")


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """64 bits; each is 1 if set in over half of the hashes of the text's word shingles, repeats included.

    A-Z are lower-cased. A text with fewer words is one shingle; one without words has fingerprint 0.
    """
    w = _WORD.findall(text.encode("utf-8", "surrogatepass").lower())
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    counts, digest = np.zeros(64, np.int64), partial(xxhash.xxh64_intdigest, seed=seed)
    for at in range(0, n, STEP):
        part = w[at : at + STEP + words - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(words)))) if len(w) >= words else [b" ".join(w)]
        counts += bit_counts(np.fromiter(map(digest, grams), np.uint64))
    return majority(counts, n)


@cache
def _tables() -> list[tuple]:
    """For each code: shift, mask, bits' syndromes, error pattern of each syndrome, syndromes by half word."""
    out, shift = [], 0
    for n, g, radius in CODES:
        deg = g.bit_length() - 1
        col, x = [], 1
        for _ in range(n):
            col.append(x)
            x <<= 1
            if x >> deg:
                x ^= g
        leader = np.zeros(1 << deg, np.uint64)
        for weight in range(radius + 1):
            for bits in combinations(range(n), weight):
                s = 0
                for b in bits:
                    s ^= col[b]
                leader[s] = sum(1 << b for b in bits)
        halves = []
        for start in (0, 12):
            t = np.zeros(1, np.int64)
            for b in range(start, min(n, start + 12)):
                t = np.concatenate([t, t ^ col[b]])
            halves.append(t)
        out.append((shift, (1 << n) - 1, np.array(col, np.int64), leader, halves))
        shift += n
    return out


def decode(fps: np.ndarray) -> np.ndarray:
    """The anchor of each 64-bit string."""
    out = np.zeros_like(fps)
    for shift, mask, _, leader, (low, high) in _tables():
        x = (fps >> np.uint64(shift)) & np.uint64(mask)
        s = low[(x & np.uint64(0xFFF)).astype(np.int64)] ^ high[(x >> np.uint64(12)).astype(np.int64)]
        out |= (x ^ leader[s]) << np.uint64(shift)
    return out


@cache
def flips(r: int) -> np.ndarray:
    """All 64-bit strings of at most r ones."""
    return np.array([sum(1 << b for b in bits) for k in range(r + 1) for bits in combinations(range(64), k)], np.uint64)


def anchors(fps: np.ndarray, r: int) -> tuple[np.ndarray, np.ndarray]:
    """(index into fps, anchor) for the anchors of all strings within r bits, each once a fingerprint."""
    every = np.sort(decode((fps[:, None] ^ flips(r)[None, :]).ravel()).reshape(len(fps), -1), axis=1)
    new = np.ones(every.shape, bool)
    new[:, 1:] = every[:, 1:] != every[:, :-1]
    return np.nonzero(new)[0], every[new]


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the edges (a, b)."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = top(x), top(y)
        if p != q:
            up[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def midpoint_links(fps: np.ndarray, ids: np.ndarray, r: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between fingerprints that share a string within r bits: those that differ in 2r at most."""
    mid = (fps[:, None] ^ flips(r)[None, :]).ravel()
    of = np.repeat(ids, len(flips(r)))
    order = np.argsort(mid, kind="stable")
    mid, of = mid[order], of[order]
    same = mid[1:] == mid[:-1]
    return _forest(of[:-1][same], of[1:][same])


def _compare(batches: Iterator[pa.RecordBatch], r: int, most: int) -> Iterator[pa.RecordBatch]:
    """Links between the rows (anchor, fp, id), sorted, of each anchor; rows of an anchor with over `most` go on as they are."""
    empty = np.empty(0, np.int64)
    held, spilling = [empty] * 3, None

    def emit(u, v, spill: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(np.full(len(u), spill))], ["u", "v", "spill"])

    def groups(a, f, i) -> Iterator[pa.RecordBatch]:
        """a, f, i: whole anchors."""
        if not len(a):
            return
        starts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        sizes = np.diff(np.r_[starts, len(a)])
        size, u, v = np.repeat(sizes, sizes), [empty], [empty]
        few = np.flatnonzero((size > 1) & (size <= SMALL))
        a2, f2, i2 = a[few], f[few], i[few]
        for lag in range(1, SMALL):
            near = (a2[lag:] == a2[:-lag]) & (np.bitwise_count((f2[lag:] ^ f2[:-lag]).view(np.uint64)) <= 2 * r)
            u.append(i2[lag:][near]), v.append(i2[:-lag][near])
        for s, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
            if links := midpoint_links(f[s : s + n].view(np.uint64), i[s : s + n], r):
                x, y = np.array(links, np.int64).T
                u.append(x), v.append(y)
        u, v = np.concatenate(u), np.concatenate(v)
        if len(u):
            yield emit(u, v, False)

    for batch in batches:
        a, f, i = (np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns, strict=True))
        if spilling is not None:  # the rest of an anchor that is too large
            n = int(np.searchsorted(a != spilling, True))
            if n:
                yield emit(i[:n], f[:n], True)
            a, f, i = a[n:], f[n:], i[n:]
            if not len(a):
                held = [empty] * 3
                continue
            spilling = None
        if not len(a):
            continue
        starts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        ends = np.r_[starts[1:], len(a)]
        big = (ends - starts) > most
        for s, e in zip(starts[big].tolist(), ends[big].tolist(), strict=True):
            yield emit(i[s:e], f[s:e], True)
        whole = ~np.repeat(big, ends - starts)
        last = int(starts[-1])
        if big[-1]:
            spilling, held = a[-1], [empty] * 3
            whole[last:] = False
        else:  # it may go on in the next batch
            held = [a[last:], f[last:], i[last:]]
            whole[last:] = False
        yield from groups(a[whole], f[whole], i[whole])
    yield from groups(*held)


def fingerprints(docs: DataFrame, text_col: str = "text", words: int = 3, seed: int = 42, name: str = "fp") -> DataFrame:
    """docs with a further long column: the fingerprint's 64 bits. Null texts are empty, and repeated rows have equal fingerprints.

    All other columns pass as they are; one that has the new one's name already is replaced. An empty table gives an empty result.
    """
    docs = without(docs, name)
    at = docs.columns.index(text_col)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"`{name}` bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py() or "", words, seed) for t in batch.column(at)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps, pa.int64())], [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def links(fps: DataFrame, shared: Shared, threshold: int = 2, most: int = LARGE) -> tuple[DataFrame, DataFrame]:
    """(id, fp) rows -> ((fp, id), the smallest id of each fingerprint; (u, v), links of these ids, which join all that differ in threshold bits or fewer)."""
    if threshold not in (0, 2, 4):
        raise ValueError("threshold must be 0, 2 or 4: midpoints need an even one, and replicas grow fast beyond 4")
    r, n = threshold // 2, int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = shared.save(fps.groupBy("fp").agg(F.min("id").alias("id")), "each")

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, ids = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for s in range(0, len(fp), 4096):
                at, anchor = anchors(fp[s : s + 4096].view(np.uint64), r)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(fp[s + at]), pa.array(ids[s + at])], ["anchor", "fp", "id"])

    rows = each.where("id IS NOT NULL").select("fp", "id").mapInArrow(replicate, "anchor bigint, fp bigint, id bigint")
    rows = rows.repartition(n, "anchor").sortWithinPartitions("anchor", "fp")
    found = shared.save(rows.mapInArrow(lambda b: _compare(b, r, most), "u bigint, v bigint, spill boolean"), "links")
    # Anchors with too many fingerprints: a midpoint has at most as many distinct ones as there are flips.
    masks = F.array(*[F.lit(int(m)) for m in flips(r).view(np.int64)])
    far = found.where("spill").select(F.col("u").alias("id"), F.col("v").alias("fp")).distinct()
    far = far.select("id", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("mid"))
    far = far.groupBy("mid").agg(F.min("id").alias("v"), F.collect_set("id").alias("us")).select(F.explode("us").alias("u"), "v")
    return each, found.where("NOT spill").select("u", "v").unionByName(far.where("u != v"))


def classes(fps: DataFrame, shared: Shared, threshold: int = 2, most: int = LARGE) -> DataFrame:
    """(id, fp) rows -> (fp, component): component is the smallest id in reach over links of at most threshold bits."""
    each, edges = links(fps, shared, threshold, most)
    found = connected_components(edges, shared)
    return each.join(found, each.id == found.node, "left").select("fp", F.coalesce("component", "id").alias("component"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42, threshold: int = 2) -> DataFrame:
    """One row per input row: id, fp (the 64 bits as a long), component.

    Ids must be integers; a null id is never a component. Null texts are empty, and texts without words
    have fingerprint 0, linked like any other. Repeated rows have the same fingerprint. An empty table
    gives an empty result; other columns are not read.
    """
    shared = Shared(docs.sparkSession, "simhash")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    fps = shared.save(fingerprints(rows, "text", words, seed).select("id", "fp"), "fingerprints")
    found = shared.save(classes(fps, shared, threshold), "classes")
    return fps.join(found, "fp", "left").select("id", "fp", "component")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42, threshold: int = 2) -> DataFrame:
    """docs with one row of each component, that with the smallest id; all columns as they were.

    Of several rows with that id in one component, the first by text stays. Rows with null ids stay if nothing with an id is near.
    """
    shared = Shared(docs.sparkSession, "neardedup")
    names = set(docs.columns)
    fp, nth = (next(f"{x}{i}" for i in range(99) if f"{x}{i}" not in names) for x in ("_fp", "_nth"))
    rows = shared.save(fingerprints(docs, text_col, words, seed, fp), "rows")
    found = shared.save(classes(rows.select(F.col(id_col).cast("long").alias("id"), F.col(fp).alias("fp")), shared, threshold), "classes")
    found = found.select(F.col("fp").alias("_of"), F.col("component").alias("_component"))
    rows = rows.join(found, (rows[fp] == F.col("_of")) & rows[id_col].cast("long").eqNullSafe(F.col("_component")))
    one = Window.partitionBy(F.coalesce("_component", F.col(fp))).orderBy(text_col)
    return rows.withColumn(nth, F.row_number().over(one)).where(F.col(nth) == 1).select(docs.columns)
