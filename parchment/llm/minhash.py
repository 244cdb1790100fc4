"""Near copies: documents whose sets of word shingles have a given Jaccard similarity or more.

First come candidates by SimHash: rows whose fingerprints of 64 bits over the same shingles differ in NEAR bits or fewer, found by anchor points
(simhash.links). Pairs of similarity 0.8 differ in more bits than anchors can cover, so rows in different components after that are compared by MinHash:
candidates are those that share all ROWS least hashes of one of BANDS bands; of pairs with similarity 0.8 all but
1.3 in ten million do, above it fewer are missed. Every candidate of either kind is verified by the whole sets, except where both are known to be in
one component already. In each of a few rounds all rows of a bucket are compared with one of it, in the first round with the most central one,
which shares the most buckets with others; then come all pairs of rows that are still in different components. So a large
bucket of copies costs its size, not the square of it. Rounds end as soon as the pairs that are left are few.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parchment.llm.common import WORD, Shared, lean, text_of
from parchment.llm.exact import Filter
from parchment.llm.graph import connected_components
from parchment.llm.simhash import bit_counts, links, majority

_WORD = re.compile(WORD.encode())
BANDS, ROWS = 40, 5
#: Bits in which fingerprints of candidates differ at most.
NEAR = 2
#: Shingles whose least hashes are taken at a time.
STEP = 512
#: Rounds of comparisons with one row of a bucket, at most, and the pairs for each row of a bucket at which they end. They change the work, not the links.
ROUNDS, FEW = 5, 4
_RNG = np.random.default_rng(42)
_A = _RNG.integers(0, 1 << 31, BANDS * ROWS, np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 1 << 32, BANDS * ROWS, np.uint32)
_FOLD = _RNG.integers(0, 1 << 63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, words: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles; A-Z are lower-cased. A text with fewer words is one shingle, one without words has none."""
    w = _WORD.findall(text.encode("utf-8", "surrogatepass").lower())
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
    n = max(1, len(w) - words + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(words, len(w))):
            out = (out ^ (out >> np.uint64(31))) * _BASE + h[k : k + n]
        out = (out ^ (out >> np.uint64(32))) * _BASE
    return np.unique(out ^ (out >> np.uint64(29)))


def bands(sets: np.ndarray) -> np.ndarray:
    """A 64-bit name of each band's least hashes."""
    h, least = (sets >> np.uint64(32)).astype(np.uint32), np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for s in range(0, len(h), STEP):
            np.minimum(least, (h[s : s + STEP, None] * _A + _B).min(0), out=least)
        x = ((least.reshape(BANDS, ROWS).astype(np.uint64) + np.uint64(1)) * _FOLD).sum(1, dtype=np.uint64)
        return ((x ^ (x >> np.uint64(32))) * _BASE).view(np.int64)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each component, that with the smallest id (nulls come last); all columns as they were.

    Rows are linked where the similarity of their shingles is percent / 100 or more. Null texts are empty; texts without words
    are alike. Of rows with the same id and other texts in one component, that with the least digest stays.
    """
    shared = Shared(docs.sparkSession, "nearcopies")
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-null")), F.lit("\n"), text_of(text_col)).cast("binary")))
    rows = docs.select(F.col(id_col).alias("id"), key.alias("key"), text_of(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            sets = [shingles(t.as_py(), words) for t in batch.column(2)]
            names = pa.array([bands(s) for s in sets], pa.list_(pa.int64()))
            fps = np.array([majority(bit_counts(s), len(s)) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(list(map(len, sets)), pa.int64()), pa.array(fps), names], ["id", "key", "size", "fp", "bands"])

    signed = rows.mapInArrow(sign, f"id {id_type}, key binary, size bigint, fp bigint, bands array<bigint>")
    each = signed.groupBy("key").agg(*[F.first(c).alias(c) for c in ("id", "size", "fp", "bands")], F.count("*").alias("rows"))
    each = shared.save(each.withColumn("node", F.monotonically_increasing_id()), "each")
    # Rows of one fingerprint with the first of them, and first rows whose fingerprints are near.
    one, far = links(each.select("fp", F.col("node").alias("id")), Shared(docs.sparkSession, "nearcopies"), NEAR)
    alike = each.join(one.withColumnRenamed("id", "v"), "fp").where("node != v").select(F.col("node").alias("u"), "v").unionByName(far)
    alike = shared.save(alike.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "alike")
    exploded = each.select("node", "size", F.explode("bands").alias("band"))
    several = exploded.groupBy("band").agg(F.count("*").alias("others")).where("others > 1")
    shared_bands = shared.save(exploded.join(several, "band"), "shared_bands")
    # How many rows a row shares buckets with: the larger, the more central it is.
    central = shared_bands.groupBy("node").agg(F.sum("others").alias("central"))
    buckets = shared.save(shared_bands.drop("others").join(central, "node"), "buckets")
    # Rows that are in a pair, share a bucket or are repeated; all others stay, and never move.
    either = alike.select(F.explode(F.array("u", "v")).alias("node"))
    marked = buckets.select("node").unionByName(either).distinct().withColumn("paired", F.lit(True))
    needed = each.join(marked, "node", "left").where("paired OR rows > 1").select("node", F.col("key").alias("digest"), "paired")
    needed = shared.save(needed, "needed")
    several = Filter.of(needed, needed.count(), shared, "several")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            sets = [shingles(t.as_py(), words).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "set"])

    hits = several.mark(rows.select(F.col("key").alias("digest"), "text")).where("hit").drop("hit")
    texts = hits.join(needed.where("paired"), "digest").select("node", "text").mapInArrow(gather, "node bigint, set array<bigint>")
    sets = shared.save(texts.dropDuplicates(["node"]), "sets")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (u, v) that are alike; sizes too far apart need no look at the sets, of which a pair at a time is in memory."""
        pairs = pairs.where(100 * F.least("su", "sv") >= percent * F.greatest("su", "sv")).select("u", "v").distinct()
        both = pairs.join(sets.select(F.col("node").alias("u"), F.col("set").alias("a")), "u").join(sets.select(F.col("node").alias("v"), F.col("set").alias("b")), "v")
        both = both.select("u", "v", (F.size("a") + F.size("b")).alias("n"), F.size(F.array_intersect("a", "b")).alias("common"))
        return shared.save(both.where(100 * F.col("common") >= percent * (F.col("n") - F.col("common"))).select("u", "v"), name)

    def settled(placed: DataFrame, joined: DataFrame, i: int) -> DataFrame:
        """placed with the components that the joined pairs make of those that were."""
        of = lambda x: placed.select(F.col("node").alias(x), F.col("c").alias(f"c{x}")).distinct()
        edges = joined.join(of("u"), "u").join(of("v"), "v").select(F.col("cu").alias("u"), F.col("cv").alias("v"))
        found = connected_components(edges, Shared(docs.sparkSession, "nearcopies")).withColumnRenamed("node", "c")
        return shared.save(placed.join(found, "c", "left").withColumn("c", F.coalesce("component", "c")).drop("component"), f"placed-{i}")

    def apart(placed: DataFrame, i: int) -> tuple[DataFrame, int, int]:
        """(rows of buckets with several components, their number, how many pairs of them are in different ones)"""
        sizes = placed.where("band IS NOT NULL").groupBy("band", "c").agg(F.count("*").alias("n")).groupBy("band").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"), F.count("*").alias("parts")).where("parts > 1")
        sizes = shared.save(sizes, f"sizes-{i}")
        rows, pairs = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum((F.col("n") * F.col("n") - F.col("same")) / 2), F.lit(0.0))).first()
        return placed.join(sizes.select("band"), "band"), rows, int(pairs)

    # What only a pair has is in no bucket.
    alone = either.distinct().join(buckets.select("node"), "node", "left_anti").join(each.select("node", "size"), "node")
    placed = buckets.unionByName(alone.withColumn("central", F.lit(0).cast("long")), allowMissingColumns=True).withColumn("c", F.col("node"))
    size = lambda x: each.select(F.col("node").alias(x), F.col("size").alias(f"s{x}"))
    placed = settled(placed, verified(alike.join(size("u"), "u").join(size("v"), "v"), "near"), 0)
    left, rows_left, pairs_left = apart(placed, 0)
    for i in range(1, ROUNDS + 1):
        if pairs_left <= (FEW if i > 1 else 0) * rows_left:
            break
        # The most central row first, any other after it.
        rank = F.col("central") if i == 1 else F.xxhash64("node", F.lit(i))
        one = left.groupBy("band").agg(F.max(F.struct(rank.alias("rank"), "node", "size", "c")).alias("e"))
        pairs = left.join(one, "band").where("c != e.c").select(F.least("node", "e.node").alias("u"), F.greatest("node", "e.node").alias("v"), F.col("size").alias("su"), F.col("e.size").alias("sv"))
        placed = settled(placed, verified(pairs, f"links-{i}"), i)
        left, rows_left, pairs_left = apart(placed, i)
    if pairs_left:
        left = shared.save(left, "left")
        other = left.select("band", F.col("node").alias("v"), F.col("size").alias("sv"), F.col("c").alias("d"))
        rest = left.join(other, "band").where("c < d").select(F.col("node").alias("u"), "v", F.col("size").alias("su"), "sv")
        placed = settled(placed, verified(rest, "rest"), ROUNDS + 1)
    found = placed.select("node", F.col("c").alias("component")).distinct()
    whole = each.join(found.select("node", "component"), "node", "left").groupBy(F.coalesce("component", "node").alias("c"))
    first = whole.agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id", "key")).alias("first"))
    kept = several.mark(first.select(F.col("first.key").alias("digest"))).where("hit").select("digest")
    kept = shared.save(kept, "kept")
    t = next(f"_row{i}" for i in range(99) if f"_row{i}" not in docs.columns)
    whole = several.mark(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(t), key.alias("digest")))
    rest = whole.where("hit").join(kept, "digest", "left_semi").withColumn("nth", F.row_number().over(Window.partitionBy("digest").orderBy(F.lit(1))))
    return whole.where("NOT hit").select(f"{t}.*").unionByName(rest.where("nth = 1").select(f"{t}.*"))
