"""Document fingerprints by winnowing.

Rolling hashes of all k-grams of code points; of each window of w consecutive ones the
smallest is chosen, the rightmost of ties; chosen positions are kept. Two texts that share w + k - 1
code points in a row share a chosen hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import text_of

#: Code points of a gram, and grams of a window.
GRAM, WINDOW = 16, 32
#: Grams handled at a time, so that memory doesn't grow with a text.
STEP = 1 << 20
#: A hash and a position share 64 bits: hash above, position within a step below.
_POSITION = 22
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-grams: sums of base powers by doubling, then mixed."""
    h, n, out, done = points.astype(np.uint64) + np.uint64(1), 1, None, 0
    power = _BASE
    while True:  # h: hashes of all n-grams; out: of all done-grams
        if k & n:
            if out is None:
                out, done = h, n
            else:
                out, done = out[: len(out) - n] * power + h[done : done + len(out) - n], done + n
        if 2 * n > k:
            break
        h, n, power = h[:-n] * power + h[n:], 2 * n, (power[None] * power)[0]
    out = (out ^ (out >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return out ^ (out >> np.uint64(32))


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, by doubling."""
    n = 1
    while 2 * n <= w:
        x, n = np.minimum(x[:-n], x[n:]), 2 * n
    return np.minimum(x[: len(x) - (w - n)], x[w - n :]) if w > n else x


def winnow(text: str, k: int = GRAM, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) chosen from the text, by position.

    A text shorter than k is one gram; one with fewer grams than w is one window. An empty text has none.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(points):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    k = min(k, len(points))
    n = len(points) - k + 1
    w = min(w, n)
    hashes, places = [], []
    with np.errstate(over="ignore"):
        for at in range(0, n - w + 1, STEP):
            end = min(n, at + STEP + w - 1)
            h = (_gram_hashes(points[at : end + k - 1], k) >> np.uint64(_POSITION + 1)).astype(np.int64)
            # Of equal hashes the rightmost position makes the smallest key.
            keys = (h << _POSITION) | ((1 << _POSITION) - 1 - np.arange(len(h)))
            chosen = np.unique(_least(keys, w))
            hashes.append(chosen >> _POSITION)
            places.append((1 << _POSITION) - 1 - (chosen & ((1 << _POSITION) - 1)) + at)
    h, p = np.concatenate(hashes), np.concatenate(places)
    order = np.argsort(p, kind="stable")
    h, p = h[order], p[order]
    if len(hashes) > 1:  # a place can be chosen on both sides of a step
        new = np.r_[True, p[1:] != p[:-1]]
        h, p = h[new], p[new]
    return h, p


def digest(chosen: tuple[np.ndarray, np.ndarray]) -> str:
    """128 bits in hexadecimal that stand for the chosen hashes and positions; empty for none."""
    h, p = chosen
    return hashlib.blake2b(h.astype("<i8").tobytes() + p.astype("<i8").tobytes(), digest_size=16).hexdigest() if len(h) else ""


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common hashes among all of two fingerprints, between 0 and 1; two empty ones are alike."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """One row per input row: id, fingerprint, hashes, positions. Null texts are empty; equal texts have equal fingerprints."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, fingerprint string, hashes array<long>, positions array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [winnow(t.as_py(), k, w) for t in batch.column(1)]
            lists = [pa.array([x[i] for x in found], pa.list_(pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([digest(x) for x in found], pa.string()), *lists], ["id", "fingerprint", "hashes", "positions"])

    return rows.mapInArrow(run, schema)


def edited(text: str, other: str) -> str:
    """text, its last half replaced by the first as many code points (or all) of the other."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """(part, id, text, own) so that, in falling order of (id, text), every row but the last of each part stands before the next document.

    Parts are ranges of ids. Each part ends with a copy of the first row of the part below
    (own is false); the lowest ends with a copy of the very first. Only bounds of parts reach the driver.
    """
    rows = docs.select(F.col("id"), F.col("text"))
    cuts = rows.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)], 10_000)).first()[0] or [] if parts > 1 else []
    cuts = sorted({int(c) for c in cuts})

    @F.pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(cuts, np.int64), ids.to_numpy(np.int64), side="right"), dtype="int32")

    keyed = rows.withColumn("part", part_of(F.coalesce("id", F.lit(-(2**63)))))
    # Null ids come last, in the lowest part; the order by text makes repeated ids' order certain.
    heads = keyed.groupBy("part").agg(F.max("id").alias("head")).collect()  # a row a part
    held = sorted(r.part for r in heads)
    above = {p: held[(i + 1) % len(held)] for i, p in enumerate(held)}  # the part whose last document p's first one follows
    heads = docs.sparkSession.createDataFrame([(r.part, r.head, above[r.part]) for r in heads], "part int, head long, above int")
    found = keyed.join(F.broadcast(heads), "part")
    own = F.struct(F.col("part").alias("part"), F.lit(True).alias("own"))
    copy = F.when(F.col("id").eqNullSafe(F.col("head")), F.struct(F.col("above").alias("part"), F.lit(False).alias("own")))
    moved = found.select("id", "text", F.explode(F.array_compact(F.array(own, copy))).alias("t"))
    return moved.select("t.part", "id", "text", "t.own")


def edit_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """One row per input row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_chosen.

    The next document is that with the next smaller id; after the last comes the first. Ids must be integers;
    null ids come last, and rows with equal ids follow each other by falling text, equal rows in any
    order, which makes no difference. Null texts are empty. A single document is its own next. An empty table gives an empty
    result; other columns are not read.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    dealt = with_next(rows, 4 * n).repartition(n, "part")
    # A copied row comes after all rows of its part: ids there are larger, or it closes the ring.
    dealt = dealt.sortWithinPartitions("part", F.col("own").desc(), F.col("id").desc_nulls_last(), F.col("text").desc())
    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_chosen long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, ended = None, None  # (part, id, text, chosen) that waits for its next; the part that is done
        for batch in batches:
            out = []
            for part, i, text, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part == ended:
                    continue  # further rows with the id of the first: the next is the first of them
                chosen = winnow(text, k, w)
                if before and before[0] == part:
                    _, bid, btext, bchosen = before
                    changed = edited(btext, text)
                    cchosen = winnow(changed, k, w)
                    sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((bid, len(btext), sha, digest(bchosen), digest(cchosen), likeness(bchosen[0], cchosen[0]), likeness(bchosen[0], chosen[0]), len(bchosen[0])))
                before, ended = ((part, i, text, chosen), None) if own else (None, part)
            if out:
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], [x.split()[0] for x in schema.split(", ")])

    return dealt.mapInArrow(run, schema)
