"""Exact deduplication by a log-structured merge index, in DataFrame operations only.

Each input split is a memtable: its digests are sorted and flushed as one run. Compaction merges FANOUT runs of a level
into one run of the next, level by level, until a batch is one run that holds, for each digest, the identifier that stays and the
count. Runs of batches gather in levels in the same way, so that an index grows by batches: what a batch brings is
looked up in the runs that are there, each behind its filter.
Hits, rows whose digest occurs more than once, are compared byte by byte with the row that stays. A filter over the hit
digests lets all other rows pass where they are: their texts never move.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parchment.llm.common import Shared, text_of

#: Runs that are merged into one.
FANOUT = 8
#: Bits of a filter for each digest, about, and the largest filter that is sent to all tasks: 2**28 bits, 32 MB, for 16 million digests.
BITS, LARGEST = 16, 28


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@dataclass
class Filter:
    """Which of 2**log2 slots digests have, in rows (bucket, bits) of 4 KB. One too large to be sent to all tasks lets everything pass."""

    log2: int
    rows: DataFrame | None

    @classmethod
    def of(cls, digests: DataFrame, n: int, shared: Shared, name: str) -> Filter:
        log2 = max(15, (BITS * max(1, n) - 1).bit_length())
        if log2 > LARGEST:
            return cls(log2, None)
        slot = F.pmod(F.xxhash64("digest"), F.lit(1 << log2))
        made = digests.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
        return cls(log2, shared.save(made, name))

    def mark(self, rows: DataFrame, name: str = "hit") -> DataFrame:
        """rows (digest, …) with a column that is false only where the digest is not in the filter. Rows stay where they are."""
        if self.rows is None:
            return rows.withColumn(name, F.lit(True))
        slot = F.pmod(F.xxhash64("digest"), F.lit(1 << self.log2))
        place = F.bitmap_bit_position(slot)
        byte = F.conv(F.hex(F.substring("_bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        held = self.rows.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
        both = rows.join(F.broadcast(held), F.bitmap_bucket_number(slot) == F.col("_bucket"), "left")
        return both.withColumn(name, F.coalesce(F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1, F.lit(False))).drop("_bucket", "_bits")


@dataclass
class Run:
    """A table (digest, k: (id, batch, rid) that stays, n), sorted by digest within files, its number of digests, and its filter."""

    rows: DataFrame
    size: int
    filter: Filter


class Index:
    """Runs in levels, one batch of documents after another. keep is "min" or "max": which id of a digest stays."""

    def __init__(self, spark: SparkSession, keep: str = "min", digest: Callable[[Column], Column] = sha256):
        self.shared, self.digest, self.best = Shared(spark, "exact"), digest, {"min": F.min, "max": F.max}[keep]
        self.levels: list[list[Run]] = [[]]
        self.made = self.batches = 0

    def _save(self, rows: DataFrame, what: str) -> DataFrame:
        self.made += 1
        return self.shared.save(rows, f"{what}-{self.made}")

    def _merged(self, rows: DataFrame, *by: str | Column) -> DataFrame:
        """Partial results meet, not rows: a digest that a third of them have costs one row a task."""
        return rows.groupBy(*by, "digest").agg(self.best("k").alias("k"), F.sum("n").alias("n"))

    def _run(self, rows: DataFrame) -> Run:
        size = rows.count()
        self.made += 1
        return Run(rows, size, Filter.of(rows, size, self.shared, f"filter-{self.made}"))

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Adds a batch; gives its rows (id, batch, rid, digest), where rid tells repeated rows apart and is fixed by being written."""
        self.batches += 1
        rows = docs.select(F.col(id_col).alias("id"), F.lit(self.batches).alias("batch"), self.digest(text_of(text_col)).alias("digest"))
        rows = rows.select("id", "batch", F.monotonically_increasing_id().alias("rid"), F.spark_partition_id().alias("memtable"), "digest")
        flushed = self._save(rows.sortWithinPartitions("digest"), "memtables")
        runs = flushed.select(F.col("memtable").alias("run"), "digest", F.struct("id", "batch", "rid").alias("k"), F.lit(1).cast("long").alias("n"))
        number = (runs.agg(F.max("run")).first()[0] or 0) + 1
        while True:
            runs = self._merged(runs, F.floor(F.col("run") / FANOUT).cast("int").alias("run"))
            runs = self._save(runs.sortWithinPartitions("run", "digest"), "level")
            number = -(-number // FANOUT)
            if number == 1:
                break
        self._add(self._run(runs.drop("run")), 0)
        return flushed.drop("memtable")

    def _add(self, run: Run, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == FANOUT:
            union = self.levels[level][0].rows
            for other in self.levels[level][1:]:
                union = union.unionByName(other.rows)
            self.levels[level] = []
            self._add(self._run(self._save(self._merged(union).sortWithinPartitions("digest"), "level")), level + 1)

    def runs(self) -> list[Run]:
        return [run for level in self.levels for run in level]

    def lookup(self, digests: DataFrame) -> DataFrame:
        """(digest, k, n) of those of the distinct digests that the index has. A run is read for those that pass its filter."""
        found = None
        for run in self.runs():
            own = run.filter.mark(digests.select("digest")).where("hit").select("digest").join(run.rows, "digest")
            found = own if found is None else found.unionByName(own)
        return self._merged(found)

    def all(self) -> DataFrame:
        """(digest, k, n) of all digests: the one run, or what lookups of all runs' digests give together."""
        runs = self.runs()
        if len(runs) == 1:
            return runs[0].rows
        union = runs[0].rows
        for other in runs[1:]:
            union = union.unionByName(other.rows)
        return self._save(self._merged(union), "all")


def _texts(docs: DataFrame, digest: Callable[[Column], Column], id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t")).withColumn("digest", digest(F.col("t")))


def _groups(docs: DataFrame, id_col: str, text_col: str, keep: str, digest: Callable[[Column], Column]) -> tuple[DataFrame, Filter]:
    """(rows as exact_groups() gives them, a filter of the digests that several rows have)."""
    index = Index(docs.sparkSession, keep, digest)
    rows = index.insert(docs, id_col, text_col)
    merged, shared = index.all(), index.shared
    hits = merged.where("n > 1").select("digest", F.col("k.id").alias("keep_id"))
    several = Filter.of(hits, hits.count(), shared, "several")
    verdict = shared.save(_verify(docs, shared, hits, several, digest, id_col, text_col), "verdict")
    marked = rows.join(merged, "digest", "left")
    plain = marked.select("id", "rid", F.col("k.id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("rid") == F.col("k.rid")).alias("kept"), "digest")
    if verdict.isEmpty():
        return plain.drop("rid"), several
    # Digests under which different texts were found: their rows are grouped by the text itself.
    mixed = verdict.select("digest").distinct()
    texts = shared.save(_texts(docs, digest, id_col, text_col).join(mixed, "digest", "left_semi").withColumn("rid", F.monotonically_increasing_id()), "texts")
    own = texts.groupBy("digest", "t").agg(index.best(F.struct("id", "rid")).alias("k"), F.count("*").alias("group_size"))
    again = texts.join(own, ["digest", "t"]).select("id", "rid", F.col("k.id").alias("keep_id"), "group_size", (F.col("rid") == F.col("k.rid")).alias("kept"), "digest")
    return plain.join(mixed, "digest", "left_anti").select(again.columns).unionByName(again).drop("rid"), several


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, digest.

    Equal means byte-equal; digests only find candidates. keep is "min" or "max":
    which id of a group stays. Null text counts as empty text. Of repeated rows
    with the same id and text, one is kept. A null id sorts before all others.
    An empty table gives an empty result. Other columns are not read.
    """
    return _groups(docs, id_col, text_col, keep, digest)[0]


def _verify(docs: DataFrame, shared: Shared, hits: DataFrame, several: Filter, digest: Callable[[Column], Column], id_col: str, text_col: str) -> DataFrame:
    """(id, digest) of each hit whose bytes differ from those of the row that stays."""
    rows = several.mark(_texts(docs, digest, id_col, text_col)).where("hit").drop("hit")
    kept = hits.select("digest", F.col("keep_id").alias("id"))
    stays = rows.join(kept, (rows.digest == kept.digest) & rows.id.eqNullSafe(kept.id), "left_semi").select("digest", F.col("t").alias("kept_text"))
    # Of rows that share the kept id and digest, any one will do: where two differ, one differs from it.
    # Written, so that Spark can split a hot digest of the join that follows.
    stays = shared.save(stays.dropDuplicates(["digest"]), "stays")
    return rows.join(stays, "digest").where(F.col("t") != F.col("kept_text")).select("id", "digest")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """docs without the rows that repeat another row's text, all columns as they were, whatever their names.

    Null texts are empty. Which row of a group stays is as in exact_groups(); of repeated rows with that id and text, the first by
    the other columns. Rows whose digest no other has stay where they are; only the others move. An empty table gives an empty result.
    """
    taken = set(docs.columns)
    d, t, n = (next(f"{x}{i}" for i in range(99) if f"{x}{i}" not in taken) for x in ("_sha", "_text", "_nth"))
    groups, several = _groups(docs, id_col, text_col, keep, sha256)
    kept = several.mark(groups.where("kept").select(F.col("id").alias("_k"), "digest")).where("hit").select("_k", F.col("digest").alias("_d"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(t), sha256(text_of(text_col)).alias("digest"))
    marked = several.mark(whole)
    alone, rows = marked.where("NOT hit").select(f"{t}.*"), marked.where("hit").select(F.col("digest").alias(d), t)
    id_ = F.col(t).getField(id_col)
    rows = rows.join(kept, (F.col(d) == F.col("_d")) & id_.eqNullSafe(F.col("_k")), "left_semi")
    one = Window.partitionBy(d, id_).orderBy(*[F.col(t).getField(c).cast("string") for c in docs.columns if c != text_col])
    return alone.unionByName(rows.withColumn(n, F.row_number().over(one)).where(F.col(n) == 1).select(f"{t}.*"))
