"""Shared pieces: reading tables, and tables written to the folder that all machines share."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(col, UPPER, LOWER)


def text_of(col: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def crc_mod(col: str, n: int) -> Column:
    """crc32 of an id written as text, modulo n."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(n))


def without(docs: DataFrame, *names: str) -> DataFrame:
    """docs less the columns of these names, which an operator is about to add."""
    taken = {n.lower() for n in names}
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken])


#: What this Python worker remembers from task to task, by name: of one operator at a time.
_kept: dict[object, object] = {}


def trim() -> None:
    """Memory that nothing uses goes back to the system; else a worker keeps the most it ever took, also while it waits."""
    pa.default_memory_pool().release_unused()
    if give := getattr(ctypes.CDLL(None), "malloc_trim", None):
        give(0)


def keep[T](name: object, make: Callable[[], T], fits: Callable[[T], bool] = lambda x: True) -> T:
    """What this worker remembers under a name, made where it is missing or doesn't fit; what other operators left in the worker goes then."""
    if name not in _kept or not fits(_kept[name]):
        forget()
        _kept[name] = make()
    return _kept[name]


def forget() -> None:
    _kept.clear()
    trim()


def lean(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, for a task that remembers nothing: the worker forgets what others left before, and gives back what it took after."""
    forget()
    for batch in batches:
        for s in range(0, len(batch), rows):
            yield batch.slice(s, rows)
    trim()


class Shared:
    """Tables under one new folder of the shared directory in spark.checkpoint.dir.

    They take the place of cached or locally checkpointed data: any executor can
    read them after another one is lost. The folder goes with scratch(), or else when Python ends.
    Where no directory is set, one is made on this machine if Spark runs on it alone; on a cluster that is an error.
    """

    _open: list[list[Shared]] = []

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            base = f"file://{tempfile.gettempdir()}/parchment-checkpoints"
            spark.conf.set("spark.checkpoint.dir", base)
        self.root = f"{base.rstrip('/')}/parchment/{what}-{uuid.uuid4().hex}"
        atexit.register(self.clear)
        for group in self._open:
            group.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, **options) -> DataFrame:
        """Writes df and returns it as read back: its lineage ends there."""
        df.write.options(**options).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str = "") -> None:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.root)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    def done(self, *names: str) -> None:
        """Drops tables that nothing reads any more, and has Spark drop the shuffles behind what was written: it does when the driver's memory is collected, which may be late."""
        for name in names:
            self.drop(name)
        self.spark.sparkContext._jvm.System.gc()

    def clear(self) -> None:
        try:
            self.drop()
        except Exception:  # noqa: BLE001  the session may have ended before Python
            pass


@contextmanager
def scratch() -> Iterator[None]:
    """Removes at its end the folders that operators opened within; results that read them must be written by then."""
    opened: list[Shared] = []
    Shared._open.append(opened)
    try:
        yield
    finally:
        Shared._open.pop()
        for shared in opened:
            shared.clear()
            atexit.unregister(shared.clear)


def sampled(rows: DataFrame, n: int, id_col: str = "id") -> DataFrame:
    """About n rows, those whose ids have the least hashes; all if there are no more. No row moves.

    The share is set from a count so that more than n are unlikely (four deviations).
    """
    total = rows.count()
    if total <= n:
        return rows
    share = max(1.0, n - 4 * n**0.5) / total
    return rows.where(F.xxhash64(id_col) < F.lit(int(-(2**63) + share * 2**64)))
