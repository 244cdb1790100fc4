"""Operators on boxes, words and crops; boxes are x0, y0, x1, y1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parchment.functions.text import normalize_space

#: The box that stands for no box.
NO_BOX = (0.0, 0.0, 10.0, 10.0)
#: Joins of words hash what stands beside them, a page's few rows, so that no task sorts words.
HASHED = "shuffle_hash"


def no_box() -> Column:
    return F.array(*map(F.lit, NO_BOX))


def polygon_box(points: Column) -> Column:
    """Bounds of an array of [x, y] points."""
    at = lambda i: F.transform(points, lambda p: F.get(p, F.lit(i)))
    return F.array(F.array_min(at(0)), F.array_min(at(1)), F.array_max(at(0)), F.array_max(at(1)))


def overlay_box(box: Column) -> Column:
    """Whole-number corners of a box of 4 numbers or of a flat polygon of 8 or more; cut toward zero."""
    side = lambda odd: F.filter(box, lambda x, i: i % 2 == odd)
    flat = F.array(F.array_min(side(0)), F.array_min(side(1)), F.array_max(side(0)), F.array_max(side(1)))
    return F.when(F.size(box) == 4, box).when(F.size(box) >= 8, flat).otherwise(no_box()).cast("array<int>")


def is_meaningful(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column, least: tuple[int, int] = (160, 80), most: float = 0.92) -> Column:
    """Whether a box is large enough to crop and does not cover nearly the whole page."""
    w, h = F.greatest(F.lit(0.0), x1 - x0), F.greatest(F.lit(0.0), y1 - y0)
    return (w >= least[0]) & (h >= least[1]) & (width > 0) & (height > 0) & ((w * h) / (width * height) < most)


def crop_box(box: DataFrame, padding: int = 24, least: tuple[int, int] = (160, 80)) -> DataFrame:
    """(x0 … y1, width, height, img_w, img_h) with left, top, right, bottom in image pixels, and whether the crop is large enough."""
    sx, sy = F.col("img_w") / F.col("width"), F.col("img_h") / F.col("height")
    edge = lambda c, s: F.bround(F.col(c) * s).cast("int")
    out = box.withColumns({
        "left": F.greatest(F.lit(0), edge("x0", sx) - padding), "top": F.greatest(F.lit(0), edge("y0", sy) - padding),
        "right": F.least(F.col("img_w"), edge("x1", sx) + padding), "bottom": F.least(F.col("img_h"), edge("y1", sy) + padding),
    })
    fits = (F.col("right") - F.col("left") >= least[0]) & (F.col("bottom") - F.col("top") >= least[1])
    return out.withColumn("crop_ok", F.coalesce((F.col("width") > 0) & (F.col("height") > 0) & fits, F.lit(False)))


def scale_words(words: DataFrame, pages: DataFrame) -> DataFrame:
    """words in page units to pixels of their page (rect_w, rect_h, width, height); blank tokens go."""
    rows = words.join(pages.hint(HASHED), ["doc_id", "page_no"]).withColumn("token", F.trim("token")).where("token != ''")
    sx, sy = (F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(1.0)) for a, b in (("width", "rect_w"), ("height", "rect_h")))
    return rows.withColumns({"x0": F.col("x0") * sx, "y0": F.col("y0") * sy, "x1": F.col("x1") * sx, "y1": F.col("y1") * sy}).select(words.columns)


def words_in_boxes(boxes: DataFrame, words: DataFrame) -> DataFrame:
    """boxes (doc_id, page_no, x0 …) with the words that lie whole within: an equi-join on the page, then ranges."""
    b, w = boxes.alias("b"), words.alias("w")
    on = (F.col("b.doc_id") == F.col("w.doc_id")) & (F.col("b.page_no") == F.col("w.page_no"))
    on &= (F.col("w.x0") >= F.col("b.x0")) & (F.col("w.y0") >= F.col("b.y0")) & (F.col("w.x1") <= F.col("b.x1")) & (F.col("w.y1") <= F.col("b.y1"))
    return b.hint(HASHED).join(w, on).select("b.*", "w.word_ord", "w.token")


def title_anchors(titles: DataFrame, words: DataFrame) -> DataFrame:
    """titles (doc_id, page_no, title) with anchor_y: the middle of the first word that holds the title, or else of the first
    word of 4 or more characters, and half as long as the title, which the title holds; null without one."""
    name = normalize_space(F.regexp_replace("title", r"^(?:\d+\.\s*|#+\s*)", ""))
    rows = titles.withColumn("name", name).alias("t")
    w = words.withColumn("norm", normalize_space(F.col("token"))).where("norm != ''").alias("w")
    holds = F.col("w.norm").contains(F.col("t.name"))
    held = F.col("t.name").contains(F.col("w.norm")) & (F.char_length("w.norm") >= F.greatest(F.lit(4), F.floor(F.char_length("t.name") / 2)))
    on = (F.col("t.doc_id") == F.col("w.doc_id")) & (F.col("t.page_no") == F.col("w.page_no")) & (F.col("t.name") != "") & (holds | held)
    found = rows.hint(HASHED).join(w, on).groupBy("t.doc_id", "t.page_no", "t.title").agg(F.min_by((F.col("w.y0") + F.col("w.y1")) / 2, F.struct(F.when(holds, 0).otherwise(1), F.col("w.word_ord"))).alias("anchor_y"))
    return titles.join(found, ["doc_id", "page_no", "title"], "left")


def estimate_boxes(blocks: DataFrame, anchors: DataFrame, least_height: int = 80) -> DataFrame:
    """Tables of blocks (doc_id, page_no, block_ord, block_type, text, x0 …, width, height) with left, top, right, bottom; null if there is no telling.

    A table's own box if it is meaningful; else from the nearest title above to the nearest below, by their
    boxes or, failing that, by where their text stands on the page (anchors of titles).
    """
    rows = blocks.join(anchors.withColumnRenamed("title", "text"), ["doc_id", "page_no", "text"], "left")
    good = is_meaningful(*(F.col(c) for c in ("x0", "y0", "x1", "y1", "width", "height")))
    title = F.when(F.col("block_type") == "title", F.struct(good.alias("good"), "y0", "y1", "anchor_y", "text"))
    order = Window.partitionBy("doc_id", "page_no").orderBy("block_ord")
    rows = rows.withColumn("above", F.last(title, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("below", F.first(title, ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)))
    rows = rows.where("block_type = 'table'")
    top = F.when(F.col("above.good"), F.least("height", F.col("above.y1") + 8.0)).when(F.col("above.anchor_y").isNotNull(), F.least("height", F.col("above.anchor_y") + 18.0)).otherwise(0.0)
    rows = rows.withColumn("_top", top)
    floor = F.col("_top") + 20.0
    bottom = F.when(F.col("below.good"), F.greatest(floor, F.col("below.y0") - 8.0)).when(F.col("below.anchor_y").isNotNull(), F.greatest(floor, F.col("below.anchor_y") - 12.0)).otherwise(F.col("height"))
    rows = rows.withColumn("_bottom", bottom)
    titled = (F.coalesce(F.col("above.text"), F.lit("")) != "") | (F.coalesce(F.col("below.text"), F.lit("")) != "")
    guess = titled & (F.col("_bottom") - F.col("_top") >= least_height)
    pick = lambda own, other: F.when(good, F.col(own)).when(guess, other)
    return rows.select(
        "doc_id", "page_no", "block_ord",
        pick("x0", F.lit(0.0)).alias("left"), pick("y0", F.col("_top")).alias("top"),
        pick("x1", F.col("width")).alias("right"), pick("y1", F.col("_bottom")).alias("bottom"),
    )


def top_left_words(tables: DataFrame, words: DataFrame) -> DataFrame:
    """tables (doc_id, page_no, block_ord, x0 …, anchor_y of the title before, or null) with the distinct words in their top left corner, by place.

    The corner takes 15 % of the width, 220 at most, and 18 % of the height, 120 at most. A table that fills
    the page takes instead the region of 420 by 110 below its title.
    """
    extent = words.groupBy("doc_id", "page_no").agg(F.max("x1").alias("page_x1"), F.max("y1").alias("page_y1"))
    t = tables.join(extent, ["doc_id", "page_no"], "left")
    w, h = F.greatest(F.lit(1.0), F.col("x1") - F.col("x0")), F.greatest(F.lit(1.0), F.col("y1") - F.col("y0"))
    px, py = F.coalesce("page_x1", "x1"), F.coalesce("page_y1", "y1")
    by_title = F.col("anchor_y").isNotNull() & (w >= px * 0.8) & (h >= py * 0.8)
    t = t.withColumns({
        "rx0": F.when(by_title, 0.0).otherwise(F.col("x0")), "ry0": F.when(by_title, F.col("anchor_y") + 8.0).otherwise(F.col("y0")),
        "rx1": F.when(by_title, F.least(px, F.lit(420.0))).otherwise(F.col("x0") + F.least(w * 0.15, F.lit(220.0))),
        "ry1": F.when(by_title, F.least(py, F.col("anchor_y") + 118.0)).otherwise(F.col("y0") + F.least(h * 0.18, F.lit(120.0))),
    }).alias("t")
    w_ = words.withColumns({"cx": (F.col("x0") + F.col("x1")) / 2, "cy": (F.col("y0") + F.col("y1")) / 2, "norm": normalize_space(F.col("token"))}).where("norm != ''").alias("w")
    on = (F.col("t.doc_id") == F.col("w.doc_id")) & (F.col("t.page_no") == F.col("w.page_no")) & F.col("w.cx").between(F.col("t.rx0"), F.col("t.rx1")) & F.col("w.cy").between(F.col("t.ry0"), F.col("t.ry1"))
    found = t.hint(HASHED).join(w_, on, "left").groupBy("t.doc_id", "t.page_no", "t.block_ord").agg(F.array_sort(F.collect_list(F.when(F.col("w.norm").isNotNull(), F.struct("w.cx", "w.cy", "w.word_ord", "w.norm")))).alias("l"))
    return found.select("doc_id", "page_no", "block_ord", F.array_distinct(F.transform("l", lambda x: x["norm"])).alias("words"))


def cells_over_words(cells: DataFrame, words: DataFrame) -> DataFrame:
    """(doc_id, page_no, block_ord, cell_ord) of the first-row cells (…, rowspan, colspan, start: columns before it; its table's x0 …, rows, cols) that
    span rows and have a word, by its middle, in the second row's band under them. Bands and columns are taken to be even."""
    cw, rh = ((F.col(b) - F.col(a)) / F.nullif(F.col(n), F.lit(0)) for a, b, n in (("x0", "x1", "cols"), ("y0", "y1", "rows")))
    c = cells.withColumns({"cx0": F.col("x0") + F.col("start") * cw, "cx1": F.col("x0") + (F.col("start") + F.col("colspan")) * cw, "ry0": F.col("y0") + rh, "ry1": F.col("y0") + 2 * rh}).alias("c")
    w = words.withColumns({"cx": (F.col("x0") + F.col("x1")) / 2, "cy": (F.col("y0") + F.col("y1")) / 2}).alias("w")
    on = (F.col("c.doc_id") == F.col("w.doc_id")) & (F.col("c.page_no") == F.col("w.page_no")) & (F.col("c.rowspan") > 1) & F.col("w.cx").between(F.col("c.cx0"), F.col("c.cx1")) & F.col("w.cy").between(F.col("c.ry0"), F.col("c.ry1"))
    on &= (F.col("w.x0") >= F.col("c.x0")) & (F.col("w.y0") >= F.col("c.y0")) & (F.col("w.x1") <= F.col("c.x1")) & (F.col("w.y1") <= F.col("c.y1"))
    return c.hint(HASHED).join(w, on).select("c.doc_id", "c.page_no", "c.block_ord", "c.cell_ord").distinct()


def span_conflicts(cells: DataFrame, words: DataFrame, columns: DataFrame) -> DataFrame:
    """First-row cells (doc_id, page_no, block_ord, cell_ord, rowspan, colspan) of tables (columns: x0 …, rows, cols) -> new row span.

    A cell that spans rows gives up one if a word stands under it (cells_over_words()): that place holds a cell of its own.
    """
    before = F.coalesce(F.sum("colspan").over(Window.partitionBy("doc_id", "page_no", "block_ord").orderBy("cell_ord").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = cells_over_words(cells.withColumn("start", before).join(columns, ["doc_id", "page_no", "block_ord"]), words).withColumn("hit", F.lit(1))
    return cells.join(found, ["doc_id", "page_no", "block_ord", "cell_ord"], "left").withColumn("rowspan", F.col("rowspan") - F.coalesce("hit", F.lit(0))).drop("hit")


def match_crops(tables: DataFrame, crops: DataFrame, by_ordinal: bool = True) -> DataFrame:
    """tables (doc_id, page_no, table_ord, block_id) with a crop (doc_id, page_no, crop_ord, crop): the one whose name holds the block's id; else of the
    page the one of the same ordinal (or the first, if not by_ordinal), the last if there are fewer; else the document's first."""
    page = crops.groupBy("doc_id", "page_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("crop_ord", "crop"))), lambda x: x.crop).alias("own"))
    first = crops.groupBy("doc_id").agg(F.min_by("crop", F.struct("page_no", "crop_ord")).alias("any"))
    rows = tables.join(page, ["doc_id", "page_no"], "left").join(first, "doc_id", "left")
    nth = F.least(F.col("table_ord"), F.size("own")) if by_ordinal else F.lit(1)
    named = F.get(F.filter("own", lambda c: c.contains(F.col("block_id"))), F.lit(0))
    return rows.withColumn("crop", F.coalesce(named, F.get("own", nth - 1), "any")).drop("own", "any")
