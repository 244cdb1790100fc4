"""Repair of recognised tables by the words of the page's text layer."""

from __future__ import annotations

import re
from itertools import count

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from parchment.functions.html import CELL_INNER, ROW_INNER, cell_text, extract_all, set_span, span_of
from parchment.functions.text import bound, normalize_space
from parchment.operators.geometry import cells_over_words, title_anchors, top_left_words

_FIRST_ROW = re.compile(r"(<tr\b[^>]*>)(.*?)(</tr>)", re.I | re.S)
_CELL = re.compile(r"<(t[dh])(\b[^>]*)>(.*?)</t[dh]>", re.I | re.S)
FIRST_CELL = r"(?is)^(.*?<tr\b[^>]*>)\s*<(t[dh])\b([^>]*)>(.*?)</t[dh]>(.*)$"


def lower_spans(html: str, cells: list[int]) -> str:
    """The table with one row less spanned by the given cells of its first row."""

    def cell(m: re.Match, at: int) -> str:
        if at not in cells:
            return m[0]
        span = int(re.search(r"rowspan\s*=\s*[\"']?(\d+)", m[2], re.I)[1]) - 1
        attrs = re.sub(r"\s*\browspan\s*=\s*[\"']?\d+[\"']?", f' rowspan="{span}"' if span > 1 else "", m[2], flags=re.I)
        return f"<{m[1]}{attrs}>{m[3]}</{m[1]}>"

    row = _FIRST_ROW.search(html)
    places = count()
    return html[: row.start(2)] + _CELL.sub(lambda m: cell(m, next(places)), row[2]) + html[row.end(2) :] if row else html


@F.pandas_udf(StringType())
def _lower_spans(html: pd.Series, cells: pd.Series) -> pd.Series:
    return pd.Series([h if c is None else lower_spans(h, list(c)) for h, c in zip(html, cells, strict=True)], dtype="object")


def split_first_headers(tables: DataFrame, words: DataFrame) -> DataFrame:
    """Tables (doc_id, page_no, block_ord, html, x0 …, anchor_y) whose first cell spans rows and columns and stands for two headers, split in two.

    The page has two or more distinct words in that corner, of which the last is the cell's text and the first is not: that one
    gets a cell of its own, and the cell one column less.
    """
    corner = top_left_words(tables, words).withColumnRenamed("words", "corner")
    rows = tables.join(corner, ["doc_id", "page_no", "block_ord"], "left")
    first, last = F.get("corner", F.lit(0)), F.element_at("corner", -1)

    def split(p: Column) -> Column:
        text = normalize_space(cell_text(p.body))
        wanted = (text != "") & (p.down >= 2) & (p.across >= 2) & (last == text) & (first != text)
        own = F.concat(F.lit("<"), p.tag, F.lit(' rowspan="'), p.down.cast("string"), F.lit('">'), first, F.lit("</"), p.tag, F.lit(">"))
        attrs = bound(set_span(p.attrs, "colspan", p.across - 1), lambda a: set_span(a, "rowspan", p.down))
        rest = F.concat(F.lit("<"), p.tag, attrs, F.lit(">"), p.body, F.lit("</"), p.tag, F.lit(">"))
        return F.when(wanted, F.concat(p.head, own, rest, p.tail))

    # The first cell's parts are taken out once, and only where the corner can split it.
    part = lambda i: F.regexp_extract("html", FIRST_CELL, i)
    parts = F.struct(part(1).alias("head"), part(2).alias("tag"), part(3).alias("attrs"), part(4).alias("body"), part(5).alias("tail"))
    spanned = lambda p: F.struct(p.head.alias("head"), p.tag.alias("tag"), p.attrs.alias("attrs"), p.body.alias("body"), p.tail.alias("tail"), span_of(p.attrs, "rowspan").alias("down"), span_of(p.attrs, "colspan").alias("across"))
    able = (F.size("corner") >= 2) & (F.regexp_count("html", F.lit(ROW_INNER)) >= 2)
    made = F.when(able, bound(bound(parts, spanned), split))
    return rows.withColumn("html", F.coalesce(made, F.col("html"))).drop("corner")


def _first_row(html: Column) -> Column:
    """(rowspan, colspan) of the first row's cells; a cell without text spans one row here, so that it is left alone."""
    filled = lambda c: normalize_space(cell_text(c)) != ""
    return F.transform(extract_all(F.regexp_extract(html, ROW_INNER, 1), CELL_INNER, 0), lambda c: F.struct(F.when(filled(c), span_of(c, "rowspan")).otherwise(1).alias("rowspan"), span_of(c, "colspan").alias("colspan")))


def first_row_cells(tables: DataFrame) -> DataFrame:
    """(…, cell_ord, rowspan, colspan) of the first row's cells; a cell without text spans one row here, so that it is left alone."""
    rows = tables.select("doc_id", "page_no", "block_ord", F.posexplode(_first_row(F.col("html"))).alias("cell_ord", "c"))
    return rows.select("doc_id", "page_no", "block_ord", "cell_ord", "c.rowspan", "c.colspan")


def shrink_spans(tables: DataFrame, words: DataFrame) -> DataFrame:
    """Tables whose first row's cells span a row less where the page has words under them. A table's cells are laid out within its row."""
    key, box = ["doc_id", "page_no", "block_ord"], ["x0", "y0", "x1", "y1"]
    width = lambda cells: F.aggregate(cells, F.lit(0), lambda a, c: a + c.colspan)
    laid = lambda cells: F.transform(cells, lambda c, i: F.struct(i.alias("cell_ord"), c.rowspan.alias("rowspan"), c.colspan.alias("colspan"), width(F.slice(cells, F.lit(1), i)).alias("start"), width(cells).alias("cols")))
    rows = tables.select(*key, *box, F.regexp_count("html", F.lit(ROW_INNER)).alias("rows"), F.explode(bound(_first_row(F.col("html")), laid)).alias("c"))
    cells = rows.where("rows >= 2").select(*key, *box, "rows", "c.*")
    hit = cells_over_words(cells, words).groupBy(*key).agg(F.collect_list("cell_ord").alias("cells"))
    return tables.join(hit, key, "left").withColumn("html", _lower_spans("html", "cells")).drop("cells")


def repair_from_words(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """Tables of blocks (doc_id, page_no, block_ord, block_type, text, html, x0 …) repaired by words; pdf_text_repaired tells which changed.

    A table's context is the last title with text before it.
    """
    order = Window.partitionBy("doc_id", "page_no").orderBy("block_ord").rowsBetween(Window.unboundedPreceding, -1)
    title = F.when((F.col("block_type") == "title") & (F.col("text") != ""), F.col("text"))
    rows = blocks.withColumn("title", F.last(title, ignorenulls=True).over(order)).where("block_type = 'table' AND html != ''")
    anchors = title_anchors(rows.where("title IS NOT NULL").select("doc_id", "page_no", "title").distinct(), words)
    rows = rows.join(anchors, ["doc_id", "page_no", "title"], "left").withColumn("before", F.col("html"))
    done = shrink_spans(split_first_headers(rows, words), words)
    return done.withColumn("pdf_text_repaired", F.col("html") != F.col("before")).drop("before", "title", "anchor_y")



def repair_blocks(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """blocks (…, bbox) with the HTML of tables as their pages' words repair it; all other columns and rows are as they were."""
    key = ["doc_id", "page_no", "block_ord"]
    corners = [F.get("bbox", F.lit(i)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]
    boxed = blocks.select(*key, "block_type", "text", "html", *corners)
    fixed = repair_from_words(boxed, words).where("pdf_text_repaired").select(*key, F.col("html").alias("_html"))
    return blocks.join(fixed, key, "left").withColumn("html", F.coalesce("_html", "html")).select(blocks.columns)
