"""Profiles of inputs: layout, complexity, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parchment.functions.text import count_numbers, lines, or_empty

# Words of table heads, marks of section titles, suffixes of images.
TABLE_HEAD = "(구분|품목수|수량|금액|목표|실적|차이|달성율|진척율|매출비율|대상건수|준수건수|합계|계획)"
SECTION = r"^(?:\d+\.\s*|[■☑#])"
IMAGES = ("png", "jpg", "jpeg", "webp", "tif", "tiff", "bmp")


def file_kind(path: Column) -> Column:
    """pdf or image by the suffix, in any case; null for anything else, so that such rows can be set aside."""
    suffix = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    return F.when(suffix == "pdf", "pdf").when(suffix.isin(*IMAGES), "image")


def text_layer(pages: DataFrame, sample: int = 3, more_than: int = 30) -> DataFrame:
    """(doc_id, text) pages by page_no -> doc_id, page_count, has_text_layer, pdf_type: over 30 characters on the first 3 pages."""
    chars = F.sum(F.when(F.col("page_no") <= sample, F.char_length(F.trim("text"))).otherwise(0))
    out = pages.groupBy("doc_id").agg(F.count("*").alias("page_count"), (F.coalesce(chars, F.lit(0)) > more_than).alias("has_text_layer"))
    return out.withColumn("pdf_type", F.when(F.col("has_text_layer"), "text").otherwise("image"))


def page_stats(rows: DataFrame) -> DataFrame:
    """(doc_id, page_no, line): stripped lines, none empty (null for a page without) -> sums by page, and its table score."""
    line, hit = F.col("line"), lambda p: F.col("line").rlike(p).cast("int")
    n = count_numbers(line)
    page = rows.groupBy("doc_id", "page_no").agg(
        F.count("line").alias("lines"),
        F.coalesce(F.sum(hit(TABLE_HEAD)), F.lit(0)).alias("heads"),
        F.coalesce(F.sum(hit(SECTION)), F.lit(0)).alias("titles"),
        F.coalesce(F.sum(F.when(line.isNotNull(), n)), F.lit(0)).alias("numbers"),
        F.coalesce(F.sum((n >= 2).cast("int")), F.lit(0)).alias("numeric_lines"),
        F.coalesce(F.sum((F.char_length(line) <= 12).cast("int")), F.lit(0)).alias("short_lines"),
        F.coalesce(F.sum(F.regexp_count(line, F.lit(TABLE_HEAD))), F.lit(0)).alias("head_words"),
    )
    hundredths = F.col("heads") * 45 + F.col("numeric_lines") * 12 + F.col("short_lines") * 3 + F.col("titles") * 10
    score = F.col("heads") * 0.45 + F.col("numeric_lines") * 0.12 + F.col("short_lines") * 0.03 + F.col("titles") * 0.10
    return page.withColumn("score", score).withColumn("hundredths", hundredths).withColumn("is_table", F.col("score") >= 1.8)


def routing_hint(layout: Column, has_text: Column) -> Column:
    return F.when(layout.isin("table_heavy", "mixed"), "prefer_paddle_vl").when(has_text, "prefer_paddle_ocr").otherwise("prefer_paddle_vl")


def layout_profile(rows: DataFrame) -> DataFrame:
    """One row a document: layout, table pages, complexity, routing and the statistics behind them."""
    tables = F.col("is_table")
    doc = page_stats(rows).groupBy("doc_id").agg(
        F.count("*").alias("page_count"),
        (F.sum("hundredths") / (F.count("*") * 100)).alias("avg"),  # whole numbers: the sum has no order
        F.count_if(tables).alias("table_pages"),
        F.sum("titles").alias("section_title_count"),
        F.sum("heads").alias("table_header_hits"),
        F.sum("numbers").alias("numbers"),
        F.sum("short_lines").alias("short_lines"),
        F.sum("lines").alias("lines"),
        F.sum(F.when(tables, F.col("head_words")).otherwise(0)).alias("table_heads"),
        F.sum(F.when(tables, F.col("numbers")).otherwise(0)).alias("table_numbers"),
        F.array_join(F.array_sort(F.collect_list(F.when(tables, F.col("page_no")))), ",").alias("probable_table_pages"),
    )
    ratio = F.col("table_pages") / F.col("page_count")
    layout = F.when((ratio >= 0.6) | (F.col("avg") >= 2.2), "table_heavy").when((F.col("avg") >= 1.2) | (F.col("table_pages") > 0), "mixed").otherwise("text_heavy")
    complex_ = (F.col("table_pages") >= 2) | (F.col("table_heads") >= 12) | (F.col("table_numbers") >= 120)
    per_line = lambda c: F.round(F.col(c) / F.greatest(F.lit(1), F.col("lines")), 3)
    return doc.select(
        "doc_id",
        "page_count",
        layout.alias("layout_type"),
        F.when(F.col("table_pages") == 0, "none").when(complex_, "complex").otherwise("simple").alias("table_complexity"),
        "probable_table_pages",
        F.round("avg", 3).alias("avg_table_score"),
        F.round(ratio, 3).alias("table_page_ratio"),
        "section_title_count",
        "table_header_hits",
        per_line("numbers").alias("numeric_density"),
        per_line("short_lines").alias("short_line_ratio"),
        routing_hint(layout, F.lit(True)).alias("routing_hint"),
    )


def profile(pages: DataFrame) -> DataFrame:
    """pages (doc_id, page_no, source_text) of documents with a text layer -> their whole profiles: file type, text layer, layout and routing."""
    text = pages.select("doc_id", "page_no", or_empty(F.col("source_text")).alias("text"))
    split = text.select("doc_id", "page_no", F.explode_outer(lines(F.col("text"))).alias("line"))
    layers = text_layer(text).drop("page_count")
    return layout_profile(split).join(layers, "doc_id").withColumn("file_type", F.lit("pdf"))


def select_engine(profiles: DataFrame, available: dict[str, bool], requested: str = "auto") -> DataFrame:
    """profiles with the engine for each document; null where the requested or any engine is missing.

    A requested engine must be there. Else: the hinted one; then the layout engine for tables, PDFs and unknown kinds; then
    the line engine; then any other.
    """
    have = {k: F.lit(bool(available.get(k))) for k in ("paddle_vl", "paddle_ocr", "surya")}
    if requested != "auto":
        return profiles.withColumn("engine", F.when(have[requested], F.lit(requested)))
    layouts = F.col("layout_type").isin("table_heavy", "mixed") | (F.col("file_type") == "pdf") | F.col("pdf_type").isin("image", "unknown")
    engine = (
        F.when((F.col("routing_hint") == "prefer_paddle_vl") & have["paddle_vl"], "paddle_vl")
        .when((F.col("routing_hint") == "prefer_paddle_ocr") & have["paddle_ocr"], "paddle_ocr")
        .when(have["paddle_vl"] & layouts, "paddle_vl")
        .when(have["paddle_ocr"], "paddle_ocr")
        .when(have["surya"], "surya")
    )
    return profiles.withColumn("engine", engine)
