"""Training sets of tables and text, with split and deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parchment.functions.html import ROW_INNER, cell_characters, clean_for_training, extract_all, structure_tokens
from parchment.functions.text import bound, or_empty, strip

# Prompts that the model is trained with.
TABLE_PROMPT, TEXT_PROMPT = "Table Recognition:", "OCR:"


def table_samples(blocks: DataFrame, least: int = 50, strict: bool = False) -> DataFrame:
    """Tables with HTML of at least (or, if strict, more than) `least` characters as (image, prompt, response, source, page, block_id)."""
    n = F.char_length(or_empty(F.col("html")))
    rows = blocks.where((F.col("block_type") == "table") & ((n > least) if strict else (n >= least)))
    return rows.select("image", F.lit(TABLE_PROMPT).alias("prompt"), clean_for_training(F.col("html")).alias("response"), "source", F.col("page_no").alias("page"), "block_id")


def text_samples(blocks: DataFrame, least: int = 5) -> DataFrame:
    rows = blocks.where(F.col("block_type").isin("text", "title") & (F.char_length(strip(F.col("text"))) >= least))
    return rows.select("image", F.lit(TEXT_PROMPT).alias("prompt"), strip(F.col("text")).alias("response"), "source", F.col("page_no").alias("page"), "block_id")


def distinct_samples(samples: DataFrame, order: list[str], prefix: int = 200) -> DataFrame:
    """The first sample, by order, of those whose responses begin alike."""
    first = F.row_number().over(Window.partitionBy(F.left("response", F.lit(prefix))).orderBy(*order))
    return samples.withColumn("_nth", first).where("_nth = 1").drop("_nth")


def split_samples(samples: DataFrame, key: Column, ratio: float = 0.1, seed: str = "42") -> DataFrame:
    """samples with split: max(1, floor(n * ratio)) rows, those with the least hashes of seed and key, are val and the rest train.

    No task sorts all rows: hashes are counted by their leading digits, more of them while the cut falls among many rows, until it falls among at most
    4096, of which only the hashes are looked at. Rows whose keys are equal to that at the cut are all val.
    """
    hashed = samples.withColumn("_h", F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))))
    hashes, found = hashed.select("_h"), ""
    n = hashes.count()
    left = max(1, int(n * ratio)) if n else 0
    while left and len(found) < 32:
        own = hashes.where(F.col("_h").startswith(found))
        digits = sorted(own.groupBy(F.substring("_h", len(found) + 1, 2).alias("d")).agg(F.count("*").alias("n")).collect())
        for r in digits:
            if r.n >= left:
                break
            left -= r.n
        found += r.d
        if r.n <= 4096:
            break
    if left and len(found) < 32:
        found = sorted(r._h for r in hashes.where(F.col("_h").startswith(found)).collect())[left - 1]
    return hashed.withColumn("split", F.when(F.col("_h") <= F.lit(found), "val").otherwise("train")).drop("_h")


def split_counts(samples: DataFrame) -> DataFrame:
    return samples.agg(F.count("*").alias("samples"), F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "val").alias("val"))


def pubtab(tables: DataFrame) -> DataFrame:
    """tables (…, html) with structure tokens and characters of cells; tables without rows are left out. Rows are taken out once."""
    # Exploded, not filtered: a filter on what html gives would have html worked out for itself.
    found = lambda rows: F.when(F.size(rows) > 0, F.array(F.struct(structure_tokens(rows).alias("structure"), cell_characters(rows).alias("cells"))))
    rows = tables.select("*", F.explode(bound(extract_all(F.col("html"), ROW_INNER), found)).alias("_found"))
    return rows.select(*[c for c in tables.columns if c not in ("structure", "cells")], "_found.structure", "_found.cells")


def file_names(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with filename, numbered from 0 in the given order within each range of rows; a range's first number is what stands before it.

    Ranges are dealt out by order, so that no task numbers all rows; one count a range reaches the driver.
    """
    dealt = rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    counts = {r._part: r.n for r in dealt.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for part in sorted(counts):
        before += [F.lit(part), F.lit(total)]
        total += counts[part]
    start = F.element_at(F.create_map(*before), F.col("_part")) if before else F.lit(0)
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1 + start
    return dealt.withColumn("filename", F.format_string("table_%04d.png", nth.cast("int"))).drop("_part")


def structure_json() -> Column:
    """One JSON text of (filename, structure, cells), as training tools read it."""
    cells = F.transform("cells", lambda c: F.struct(c.alias("tokens")))
    return F.to_json(F.struct("filename", F.struct(F.struct(F.col("structure").alias("tokens")).alias("structure"), cells.alias("cells")).alias("html")))


def pubtab_json(rows: DataFrame) -> DataFrame:
    """(filename, structure, cells) -> one JSON text a row."""
    return rows.select(structure_json().alias("value"))
