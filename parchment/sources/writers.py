"""Writers: nested results, JSON lines by split, plain text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nest(docs: DataFrame, pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row a document with its pages and their blocks inside, in order; the field order is that of saved results."""
    by = ["doc_id", "page_no"]
    block = F.struct("block_ord", *[c for c in blocks.columns if c not in ("doc_id", "block_ord")])
    listed = blocks.groupBy(*by).agg(F.array_sort(F.collect_list(block)).alias("blocks"))
    page = pages.join(listed, by, "left")
    packed = page.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_no", *[c for c in page.columns if c not in by]))).alias("pages"))
    return docs.join(packed, "doc_id", "left")


def save_documents(nested: DataFrame, path: str) -> None:
    nested.write.mode("overwrite").json(path)


def save_pretty(nested: DataFrame, path: str) -> None:
    """Indented JSON, a document after the other; letters beyond ASCII stay as they are."""
    text = F.to_json(F.struct(*nested.columns), {"pretty": "true", "ignoreNullFields": "false"})
    nested.select(text.alias("value")).write.mode("overwrite").text(path)


def save_splits(samples: DataFrame, path: str) -> None:
    """JSON lines in a folder a split."""
    samples.write.mode("overwrite").partitionBy("split").json(path)


def save_text(rows: DataFrame, column: str, path: str) -> None:
    rows.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)
