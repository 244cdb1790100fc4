"""Document tables derived from the star-schema test tables, each with the same definition in SQL.

The engine's own inputs (pages, lines, words, blocks, tables) are stood in for by customers (documents), orders
(pages) and line items (lines, blocks, rows). SQL definitions are common table expressions named like the functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


ITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of_number(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(12,2)").cast("string")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_no, orderkey, status)"""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    nth = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return o.select(F.col("o_custkey").alias("doc_id"), nth.alias("page_no"), F.col("o_orderkey").alias("orderkey"), F.col("o_orderstatus").alias("status"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(orderkey, n from 1, partkey, quantity, price, discount, returnflag)"""
    l = read(spark, sf_dir, "lineitem")  # noqa: E741
    nth = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*ITEM_ORDER[1:]))
    return l.select(F.col("l_orderkey").alias("orderkey"), nth.alias("n"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("partkey"), text_of_number("l_quantity").alias("quantity"), text_of_number("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"), F.col("l_returnflag").alias("returnflag"))


SQL_ORDERS = """orders_ AS (SELECT o_custkey AS doc_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)::INT AS page_no, o_orderkey AS orderkey, o_orderstatus AS status FROM orders),
items_ AS (SELECT l_orderkey AS orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)::INT AS n, l_linenumber AS line, l_partkey AS partkey,
    l_quantity::DECIMAL(12,2)::VARCHAR AS quantity, l_extendedprice::DECIMAL(12,2)::VARCHAR AS price, l_discount AS discount, l_returnflag AS returnflag FROM lineitem)"""


def order_items(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """(orderkey, x): an order's items in their order as one array, with the columns of ITEM_ORDER after the key, and more. Items are shuffled once, by order."""
    rows = read(spark, sf_dir, "lineitem")
    return rows.groupBy(F.col("l_orderkey").alias("orderkey")).agg(F.sort_array(F.collect_list(F.struct(*ITEM_ORDER[1:], *more))).alias("x"))


def line_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_no, lines: array of line_ord and line): a page's lines in their order. Rows are pages from the start, so that no task sorts lines."""
    heads = F.when(F.col("status") == "F", F.array(*map(F.lit, ("1. Order", "구분", "수량", "금액", "합계")))).when(F.col("status") == "O", F.array(*map(F.lit, ("1. Order", "수량", "금액")))).otherwise(F.array(F.lit("1. Order")))
    top = F.transform(heads, lambda h, i: F.struct(i.alias("line_ord"), h.alias("line")))
    body = F.transform("x", lambda a, i: F.struct((i + 101).alias("line_ord"), F.concat(F.lit("item "), a.l_partkey, F.lit(" qty "), text_of_number(a.l_quantity)).alias("line")))
    o = orders(spark, sf_dir).join(order_items(spark, sf_dir, "l_quantity"), "orderkey", "left")
    return o.select("doc_id", "page_no", F.when(F.col("x").isNull(), top).otherwise(F.concat(top, body)).alias("lines"))


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_no, line_ord, line)"""
    return line_lists(spark, sf_dir).select("doc_id", "page_no", F.inline("lines"))


SQL_LINES = SQL_ORDERS + """,
page_lines AS (SELECT doc_id, page_no, i AS line_ord, ([CASE WHEN i >= 0 THEN '1. Order' END] || CASE status WHEN 'F' THEN ['구분', '수량', '금액', '합계'] WHEN 'O' THEN ['수량', '금액'] ELSE [] END)[i + 1] AS line
        FROM (SELECT *, unnest(range(0, CASE status WHEN 'F' THEN 5 WHEN 'O' THEN 3 ELSE 1 END)) AS i FROM orders_)
    UNION ALL SELECT doc_id, page_no, n + 100, 'item ' || partkey || ' qty ' || quantity FROM orders_ JOIN items_ USING (orderkey))"""


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_no, block_ord, block_id, block_type, text, html, markdown, confidence, bbox, review_reason, review)"""
    i = orders(spark, sf_dir).join(order_items(spark, sf_dir, "l_discount", "l_returnflag"), "orderkey").select("doc_id", "page_no", "status", F.posexplode("x").alias("i", "x"))
    i = i.select("doc_id", "page_no", "status", (F.col("i") + 1).alias("n"), F.col("x.l_linenumber").alias("line"), F.col("x.l_partkey").alias("partkey"), F.col("x.l_discount").alias("discount"), F.col("x.l_returnflag").alias("returnflag"))
    kind = F.when(F.col("returnflag") == "A", "text").when(F.col("returnflag") == "N", "table").otherwise("title")
    html = F.when((F.col("returnflag") == "N") & F.col("status").isin("N", "O"), "<table></table>").otherwise("")
    text = F.when((F.col("returnflag") == "N") | (F.col("line") % 4 == 0), "").when(F.col("line") % 4 == 1, "7 7 7").otherwise(F.concat(F.lit("item "), "partkey"))
    box = [F.lit(10.0), F.col("n") * 20.0, F.lit(10.0) + F.col("partkey") % 500, F.col("n") * 20.0 + 12.5]
    return i.select(
        "doc_id", "page_no", F.col("n").alias("block_ord"), F.concat(F.lit("p"), "page_no", F.lit("_b"), "n").alias("block_id"), kind.alias("block_type"), text.alias("text"), html.alias("html"),
        F.lit("").alias("markdown"), (0.95 - 3 * F.col("discount")).alias("confidence"), F.array(*box).alias("bbox"), F.array().cast("array<string>").alias("review_reason"), F.lit(False).alias("review"),
    )


SQL_BLOCKS = SQL_ORDERS + """,
blocks AS (SELECT doc_id, page_no, n AS block_ord, 'p' || page_no || '_b' || n AS block_id, CASE returnflag WHEN 'A' THEN 'text' WHEN 'N' THEN 'table' ELSE 'title' END AS block_type,
    CASE WHEN returnflag = 'N' OR line % 4 = 0 THEN '' WHEN line % 4 = 1 THEN '7 7 7' ELSE 'item ' || partkey END AS text, CASE WHEN returnflag = 'N' AND status IN ('N', 'O') THEN '<table></table>' ELSE '' END AS html,
    0.95 - 3 * discount AS confidence, [10.0::DOUBLE, n * 20.0::DOUBLE, 10.0::DOUBLE + partkey % 500, n * 20.0::DOUBLE + 12.5] AS bbox FROM orders_ JOIN items_ USING (orderkey)),
scored AS (SELECT *, greatest(0, least(1, confidence - CASE WHEN text = '' AND html = '' THEN 0.30 ELSE 0 END - CASE WHEN block_type = 'table' AND html = '' THEN 0.20 ELSE 0 END - CASE WHEN text = '7 7 7' THEN 0.05 ELSE 0 END)) AS c FROM blocks),
final_blocks AS (SELECT doc_id, page_no, block_ord, block_id, block_type, text, html, bbox, c AS confidence, c < 0.65 AS review,
    list_sort(list_filter([CASE WHEN text = '' AND html = '' THEN 'empty_content' END, CASE WHEN block_type = 'table' AND html = '' THEN 'table_without_html' END, CASE WHEN text = '7 7 7' THEN 'repetitive_numeric_pattern' END, CASE WHEN c < 0.65 THEN 'low_block_confidence' END], lambda x: x IS NOT NULL)) AS reasons FROM scored),
final_pages AS (SELECT o.doc_id, o.page_no, count(b.block_ord) AS n_blocks, coalesce(sum(b.confidence::DECIMAL(20,12))::DOUBLE / count(b.confidence), 0) AS page_confidence, coalesce(sum(b.confidence::DECIMAL(20,12))::DOUBLE / count(b.confidence), 0) < 0.70 OR coalesce(bool_or(b.review), false) AS needs_review
    FROM orders_ o LEFT JOIN final_blocks b ON o.doc_id = b.doc_id AND o.page_no = b.page_no GROUP BY o.doc_id, o.page_no)"""


def text_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_no, source_text, ocr_text): words as they are, with some dropped, or with some letters changed, by doc_id modulo 4. Line ends in the source are spaces."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.split(F.trim(F.regexp_replace("text", r"[ \t\n\r\x0b\x0c]+", " ")), " ").alias("w"))
    kind = F.col("doc_id") % 4
    keep = F.filter("w", lambda x, i: ~(((kind == 1) & (i % 25 == 5)) | ((kind == 2) & (i % 8 == 5))))
    changed = F.transform(keep, lambda x, i: F.when((kind == 3) & (i % 3 == 0), F.replace(x, F.lit("e"), F.lit("3"))).otherwise(x))
    return d.select("doc_id", F.lit(1).alias("page_no"), F.array_join("w", " ").alias("source_text"), F.array_join(changed, " ").alias("ocr_text"))


SQL_PAIRS = r"""words_ AS (SELECT doc_id, string_split(trim(regexp_replace(text, '[ \t\n\r\x0b\x0c]+', ' ', 'g')), ' ') AS w FROM documents),
kept_ AS (SELECT doc_id, w, list_filter(w, lambda x, i: NOT ((doc_id % 4 = 1 AND (i - 1) % 25 = 5) OR (doc_id % 4 = 2 AND (i - 1) % 8 = 5))) AS k FROM words_),
pairs AS (SELECT doc_id, array_to_string(w, ' ') AS source_text, array_to_string(list_transform(k, lambda x, i: CASE WHEN doc_id % 4 = 3 AND (i - 1) % 3 = 0 THEN replace(x, 'e', '3') ELSE x END), ' ') AS ocr_text FROM kept_),
tokens_ AS (SELECT doc_id, source_text, ocr_text, list_distinct(string_split(source_text, ' ')) AS s, list_distinct(string_split(ocr_text, ' ')) AS o FROM pairs)"""


def order_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_no, orderkey, html, markdown): an order's items as a table, with styles, a span past the last row, and empty cells at some rows' ends."""

    def row(x, i):
        first = F.when(i == F.size("x") - 1, '<td rowspan="9">').otherwise("<td>")
        pad = F.when(i % 3 == 2, "<td></td><td></td></tr>").otherwise("</tr>")
        return F.concat(F.lit("<tr>"), first, F.lit("item"), x.l_partkey, F.lit('</td><td style="color:red">'), text_of_number(x.l_quantity), F.lit("</td><td>"), text_of_number(x.l_extendedprice), F.lit("</td>"), pad)

    md = lambda x: F.concat(F.lit("| item"), x.l_partkey, F.lit(" | "), text_of_number(x.l_quantity), F.lit(" | "), text_of_number(x.l_extendedprice), F.lit(" |\n"))
    html = F.concat(F.lit('<table border="1" style="w:1"><tr><th>품목</th><th>수량</th> <th>금액</th></tr>\n'), F.array_join(F.transform("x", row), ""), F.lit("</table>"))
    markdown = F.concat(F.lit("| 품목 | 수량 | 금액 |\n|---|---|---|\n"), F.array_join(F.transform("x", md), ""))
    rows = orders(spark, sf_dir).join(order_items(spark, sf_dir, "l_quantity"), "orderkey")
    return rows.select("doc_id", "page_no", "orderkey", html.alias("html"), markdown.alias("markdown"))


SQL_TABLES = SQL_ORDERS + """,
rows_ AS (SELECT doc_id, page_no, orderkey, n, '<tr>' || CASE WHEN n = max(n) OVER (PARTITION BY orderkey) THEN '<td rowspan="9">' ELSE '<td>' END || 'item' || partkey || '</td><td style="color:red">' || quantity || '</td><td>' || price || '</td>' || CASE WHEN n % 3 = 0 THEN '<td></td><td></td>' ELSE '' END || '</tr>' AS row,
    '| item' || partkey || ' | ' || quantity || ' | ' || price || ' |' || chr(10) AS md, partkey, quantity, price FROM orders_ JOIN items_ USING (orderkey)),
tables AS (SELECT doc_id, page_no, orderkey, '<table border="1" style="w:1"><tr><th>품목</th><th>수량</th> <th>금액</th></tr>' || chr(10) || string_agg(row, '' ORDER BY n) || '</table>' AS html, '| 품목 | 수량 | 금액 |' || chr(10) || '|---|---|---|' || chr(10) || string_agg(md, '' ORDER BY n) AS markdown,
    count(*) AS n_rows, string_agg('<tr><td>item' || partkey || '</td><td>' || quantity || '</td><td>' || price || '</td></tr>', '' ORDER BY n) AS plain FROM rows_ GROUP BY doc_id, page_no, orderkey)"""


def table_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(orderkey, gt_html, pred_html): each fourth cell of the prediction says wrong; each fifth order's is in the native cell format."""
    t = order_tables(spark, sf_dir).select("orderkey", F.col("html").alias("gt_html"))
    cells = F.regexp_extract_all("gt_html", F.lit(r"<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1))
    changed = F.transform(cells, lambda c, i: F.when(i % 4 == 3, F.lit("wrong")).otherwise(c))
    html = F.concat(F.lit("<table><tr>"), F.array_join(F.transform(changed, lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))), ""), F.lit("</tr></table>"))
    native = F.concat(F.array_join(F.transform(changed, lambda c: F.concat(F.lit("<fcel>"), c, F.lit("</fcel>"))), ""), F.lit("<nl>"))
    return t.withColumn("pred_html", F.when(F.col("orderkey") % 5 == 0, native).otherwise(html))


SQL_TABLE_PAIRS = SQL_TABLES + r""",
cells_ AS (SELECT orderkey, html AS gt_html, regexp_extract_all(html, '(?s)<t[dh][^>]*>(.*?)</t[dh]>', 1) AS g FROM tables),
changed_ AS (SELECT *, list_transform(g, lambda c, i: CASE WHEN (i - 1) % 4 = 3 THEN 'wrong' ELSE c END) AS p FROM cells_),
full_ AS (SELECT *, list_filter(g, lambda c: c <> '') AS gt, list_filter(p, lambda c: c <> '') AS pred, len(regexp_extract_all(gt_html, '<tr')) AS gt_rows FROM changed_)"""


def merged_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table_id, html): for each customer all orders in one table, each with a header of three cells, or of six if its key is divisible by 3."""
    o = orders(spark, sf_dir)
    head = F.when(F.col("orderkey") % 3 == 0, "<tr><th>구분</th><th>수량</th><th>금액</th><th>비율</th><th>계획</th><th>실적</th></tr>").otherwise("<tr><th>구분</th><th>수량</th><th>금액</th></tr>")
    row = lambda x: F.concat(F.lit("<tr><td>item"), x.l_partkey, F.lit("</td><td>"), text_of_number(x.l_quantity), F.lit("</td><td>"), text_of_number(x.l_extendedprice), F.lit("</td></tr>"))
    rows = o.join(order_items(spark, sf_dir, "l_quantity"), "orderkey", "left")
    rows = rows.select("doc_id", F.struct("page_no", F.concat(head, F.coalesce(F.array_join(F.transform("x", row), ""), F.lit(""))).alias("rows")).alias("x"))
    whole = F.array_join(F.sort_array(F.collect_list("x"))["rows"], "")
    return rows.groupBy("doc_id").agg(F.concat(F.lit("<table>"), whole, F.lit("</table>")).alias("html")).withColumnRenamed("doc_id", "table_id")


def line_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_no, raw): JSON of the line engine; the list of scores is one short where the order is divisible by 7."""
    o = orders(spark, sf_dir).join(items(spark, sf_dir), "orderkey")
    x = F.array_sort(F.collect_list(F.struct("n", "partkey", "discount")))
    grouped = o.groupBy("doc_id", "page_no", "orderkey").agg(x.alias("x"))
    poly = lambda a: F.array(*[F.array(px, py) for px, py in ((F.lit(0.0), a.n * 10.0), (a.partkey * 1.0, a.n * 10.0), (a.partkey * 1.0, a.n * 10.0 + 8), (F.lit(0.0), a.n * 10.0 + 8))])
    scores = F.transform("x", lambda a: 1.0 - a.discount)
    scores = F.when(F.col("orderkey") % 7 == 0, F.slice(scores, F.lit(1), F.size("x") - 1)).otherwise(scores)
    raw = F.to_json(F.struct(F.transform("x", lambda a: F.concat(F.lit(" item  "), a.partkey)).alias("rec_texts"), scores.alias("rec_scores"), F.transform("x", poly).alias("dt_polys")))
    return grouped.select("doc_id", "page_no", raw.alias("raw"))


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_no, word_ord, x0, y0, x1, y1, token): words of lines on a page of 600 by 800."""
    pages = line_lists(spark, sf_dir).repartition("doc_id", "page_no").select("doc_id", "page_no", F.posexplode("lines").alias("at", "l"))
    w = pages.select("doc_id", "page_no", (F.col("at") + 1).alias("line_no"), F.posexplode(F.split("l.line", " ")).alias("i", "token"))
    x, y = (F.col("i") % 12) * 40.0, F.col("line_no") * 14.0
    return w.select("doc_id", "page_no", (F.col("line_no") * 100 + F.col("i")).alias("word_ord"), x.alias("x0"), y.alias("y0"), (x + 36).alias("x1"), (y + 12).alias("y1"), "token")


SQL_WORDS = SQL_LINES + """,
numbered_ AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_no ORDER BY line_ord)::INT AS line_no, string_split(line, ' ') AS w FROM page_lines),
words AS (SELECT doc_id, page_no, (line_no * 100 + i)::INT AS word_ord, (i % 12) * 40.0::DOUBLE AS x0, line_no * 14.0::DOUBLE AS y0, (i % 12) * 40.0::DOUBLE + 36 AS x1, line_no * 14.0::DOUBLE + 12 AS y1, w[i + 1] AS token FROM (SELECT *, unnest(range(0, len(w))) AS i FROM numbered_))"""


def table_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_no, block_ord, x0 …, width, height): a table a page, of a size that its order gives; each fifth fills the page."""
    o = orders(spark, sf_dir)
    k, full = F.col("orderkey"), F.col("orderkey") % 5 == 0
    side = lambda other, v: F.when(full, F.lit(other)).otherwise(v)
    return o.select(
        "doc_id", "page_no", F.lit(1).alias("block_ord"), side(0.0, (k % 7) * 10.0).alias("x0"), side(0.0, (k % 11) * 7.0).alias("y0"),
        side(600.0, (k % 7) * 10.0 + 100 + k % 300).alias("x1"), side(800.0, (k % 11) * 7.0 + 60 + k % 90).alias("y1"), F.lit(600).alias("width"), F.lit(800).alias("height"), k.alias("orderkey"),
    )


SQL_BOXES = SQL_WORDS + """,
boxes AS (SELECT doc_id, page_no, 1 AS block_ord, CASE WHEN orderkey % 5 = 0 THEN 0 ELSE (orderkey % 7) * 10.0 END::DOUBLE AS x0, CASE WHEN orderkey % 5 = 0 THEN 0 ELSE (orderkey % 11) * 7.0 END::DOUBLE AS y0,
    CASE WHEN orderkey % 5 = 0 THEN 600 ELSE (orderkey % 7) * 10.0 + 100 + orderkey % 300 END::DOUBLE AS x1, CASE WHEN orderkey % 5 = 0 THEN 800 ELSE (orderkey % 11) * 7.0 + 60 + orderkey % 90 END::DOUBLE AS y1, orderkey FROM orders_)"""


def page_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_no, raw): nested JSON of the layout engine out of web pages' headings, paragraphs and list items, under names that vary."""
    p = read(spark, sf_dir, "pages")
    plain = lambda c: F.regexp_replace(c, "<[^>]+>", "")
    found = lambda tag: F.transform(F.regexp_extract_all("html", F.lit(rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1)), plain)
    v = F.col("page_id") % 5
    kind, text = F.when(v == 0, "block_label").when(v == 1, "type").otherwise("label"), F.when(v == 0, "block_content").when(v == 1, "content").otherwise("text")
    entry = lambda k, x, i: F.map_from_arrays(F.array(kind, text, F.lit("score"), F.lit("bbox")), F.array(F.to_json(F.array(F.lit(k))), F.to_json(F.array(x)), F.to_json(F.array(F.lit(0.5) + (i % 4) * 0.1)), F.to_json(F.array(F.array(i * 1.0, i * 2.0, i * 1.0 + 50, i * 2.0 + 10)))))
    # Values are JSON arrays of one, so that maps hold text only; their brackets go.
    blocks_ = F.concat(F.transform(found("h1"), lambda x, i: entry("doc_title", x, i)), F.transform(found("p"), lambda x, i: entry("text", x, i)), F.transform(found("li"), lambda x, i: entry("text", x, i)))
    as_json = F.transform(blocks_, lambda m: F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(F.lit('"'), e.key, F.lit('":'), F.substring(e.value, F.lit(2), F.length(e.value) - 2))), ","), F.lit("}")))
    table = '{"type":"table","html":"<table><tr><td>a</td></tr><tr><td>b</td></tr></table>","children":[{"type":"text","text":"inner","rec_score":1.7}]}'
    raw = F.concat(F.lit('{"width":0,"img_w":600,"input_img":{"width":5,"height":800},"img_path":"'), "url", F.lit('","res":{"boxes":['), F.array_join(F.concat(as_json, F.array(F.lit(table), F.lit(table))), ","), F.lit("]}}"))
    return p.select(F.col("page_id").alias("doc_id"), F.lit(1).alias("page_no"), raw.alias("raw"), F.concat(F.lit("# "), F.array_join(found("h1"), " "), F.lit("\n\n"), F.array_join(found("p"), "\n\n"), F.lit("\n\n| a | b |\n|---|---|\n| 1 | 2 |\n\nafter")).alias("markdown"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of tables and text as dataset builders take them, with an image and a source."""
    t = order_tables(spark, sf_dir)
    return t.select("doc_id", "page_no", F.lit(1).alias("block_ord"), F.concat(F.lit("p"), "page_no", F.lit("_b1")).alias("block_id"), F.lit("table").alias("block_type"), F.lit("").alias("text"), "html", "orderkey", F.concat(F.lit("page_"), F.lpad("page_no", 4, "0"), F.lit("_table_001.png")).alias("image"), F.concat(F.lit("doc"), "doc_id").alias("source"))


