"""Every query of the engine by name, with SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.functions import html as H
from parchment.functions import text as X
from parchment.operators import compare, datasets, geometry, page_text, parsing, profiling, quality, render, tables
from parchment.sources import fixtures as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
FLAGSHIP = "layout_profile"


def query(sql: str = ""):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# The same patterns as in the functions, for the checking engine.
_HEAD = "(구분|품목수|수량|금액|목표|실적|차이|달성율|진척율|매출비율|대상건수|준수건수|합계|계획)"
_NUM = r"[-+]?\d[\d,]*(?:\.\d+)?%?"
_PROFILE = S.SQL_LINES + rf""",
page_ AS (SELECT doc_id, page_no, count(*) AS lines, count(*) FILTER (regexp_matches(line, '{_HEAD}')) AS heads, count(*) FILTER (regexp_matches(line, '^(?:\d+\.\s*|[■☑#])')) AS titles, sum(len(regexp_extract_all(line, '{_NUM}'))) AS numbers,
    count(*) FILTER (len(regexp_extract_all(line, '{_NUM}')) >= 2) AS numeric_lines, count(*) FILTER (len(line) <= 12) AS short_lines, sum(len(regexp_extract_all(line, '{_HEAD}'))) AS head_words FROM page_lines GROUP BY doc_id, page_no),
stats_ AS (SELECT *, heads * 45 + numeric_lines * 12 + short_lines * 3 + titles * 10 AS hundredths, heads * 0.45::DOUBLE + numeric_lines * 0.12::DOUBLE + short_lines * 0.03::DOUBLE + titles * 0.10::DOUBLE AS score FROM page_),
doc_ AS (SELECT doc_id, count(*) AS page_count, sum(hundredths) / (count(*) * 100) AS avg_, count(*) FILTER (score >= 1.8) AS table_pages, sum(titles)::BIGINT AS section_title_count, sum(heads)::BIGINT AS table_header_hits, sum(numbers) AS numbers, sum(short_lines) AS short_lines, sum(lines) AS lines,
    coalesce(sum(head_words) FILTER (score >= 1.8), 0) AS table_heads, coalesce(sum(numbers) FILTER (score >= 1.8), 0) AS table_numbers, coalesce(string_agg(page_no::VARCHAR, ',' ORDER BY page_no) FILTER (score >= 1.8), '') AS probable_table_pages FROM stats_ GROUP BY doc_id),
profile AS (SELECT doc_id, page_count, CASE WHEN table_pages / page_count >= 0.6 OR avg_ >= 2.2 THEN 'table_heavy' WHEN avg_ >= 1.2 OR table_pages > 0 THEN 'mixed' ELSE 'text_heavy' END AS layout_type,
    CASE WHEN table_pages = 0 THEN 'none' WHEN table_pages >= 2 OR table_heads >= 12 OR table_numbers >= 120 THEN 'complex' ELSE 'simple' END AS table_complexity, probable_table_pages, round(avg_, 3) AS avg_table_score, round(table_pages / page_count, 3) AS table_page_ratio,
    section_title_count, table_header_hits, round(numbers / lines, 3) AS numeric_density, round(short_lines / lines, 3) AS short_line_ratio FROM doc_)"""


@query(f"WITH {_PROFILE} SELECT *, CASE WHEN layout_type = 'text_heavy' THEN 'prefer_paddle_ocr' ELSE 'prefer_paddle_vl' END AS routing_hint FROM profile")
def layout_profile(spark, sf_dir):
    return profiling.layout_profile(S.page_lines(spark, sf_dir))


@query(f"WITH {_PROFILE} SELECT doc_id, layout_type, CASE WHEN layout_type = 'text_heavy' THEN 'paddle_ocr' ELSE 'paddle_vl' END AS engine FROM profile")
def select_engine(spark, sf_dir):
    p = profiling.layout_profile(S.page_lines(spark, sf_dir)).withColumns({"file_type": F.lit("pdf"), "pdf_type": F.lit("text")})
    return profiling.select_engine(p, {"paddle_vl": True, "paddle_ocr": True}).select("doc_id", "layout_type", "engine")


@query(f"WITH {S.SQL_LINES}, texts AS (SELECT doc_id, page_no, trim(string_agg(line, chr(10) ORDER BY line_ord)) AS t FROM page_lines GROUP BY doc_id, page_no), d AS (SELECT doc_id, count(*) AS page_count, coalesce(sum(len(t)) FILTER (page_no <= 3), 0) > 30 AS has_text_layer FROM texts GROUP BY doc_id) SELECT *, CASE WHEN has_text_layer THEN 'text' ELSE 'image' END AS pdf_type FROM d")
def text_layer(spark, sf_dir):
    lines = S.page_lines(spark, sf_dir)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_ord", "line"))), lambda x: x.line), "\n")
    return profiling.text_layer(lines.groupBy("doc_id", "page_no").agg(text.alias("text")))


@query("SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'pdf' WHEN 3 THEN NULL ELSE 'image' END AS file_type FROM pages")
def file_kinds(spark, sf_dir):
    suffix = F.element_at(F.array(*map(F.lit, (".PDF", ".png", ".TIFF", ".docx"))), (F.col("page_id") % 4 + 1).cast("int"))
    return S.read(spark, sf_dir, "pages").select("page_id", profiling.file_kind(F.concat("url", suffix)).alias("file_type"))


@query(f"WITH {S.SQL_BLOCKS} SELECT doc_id, page_no, block_id, round(confidence, 6) AS confidence, review, array_to_string(reasons, ',') AS reasons FROM final_blocks")
def block_scores(spark, sf_dir):
    return quality.score_blocks(S.blocks(spark, sf_dir)).select("doc_id", "page_no", "block_id", F.round("confidence", 6).alias("confidence"), "review", F.array_join("review_reason", ",").alias("reasons"))


def _scored_pages(spark, sf_dir):
    return quality.score_pages(S.orders(spark, sf_dir).select("doc_id", "page_no"), quality.score_blocks(S.blocks(spark, sf_dir)))


@query(f"WITH {S.SQL_BLOCKS} SELECT doc_id, page_no, n_blocks, round(page_confidence, 6) AS page_confidence, needs_review, concat_ws(',', CASE WHEN page_confidence < 0.70 THEN 'low_page_confidence' END, CASE WHEN n_blocks = 0 THEN 'page_without_blocks' END) AS reasons FROM final_pages")
def page_scores(spark, sf_dir):
    return _scored_pages(spark, sf_dir).select("doc_id", "page_no", "n_blocks", F.round("page_confidence", 6).alias("page_confidence"), "needs_review", F.array_join("review_reason", ",").alias("reasons"))


@query(f"WITH {S.SQL_BLOCKS} SELECT doc_id, count(*) AS page_count, round(coalesce(sum(page_confidence::DECIMAL(20,12)) FILTER (n_blocks > 0)::DOUBLE / count(*) FILTER (n_blocks > 0), 0), 6) AS overall_confidence, coalesce(string_agg(page_no::VARCHAR, ',' ORDER BY page_no) FILTER (needs_review), '') AS review_pages FROM final_pages GROUP BY doc_id")
def document_scores(spark, sf_dir):
    return quality.score_documents(_scored_pages(spark, sf_dir)).select("doc_id", "page_count", F.round("overall_confidence", 6).alias("overall_confidence"), F.array_join("review_required_pages", ",").alias("review_pages"))


@query(f"WITH {S.SQL_BLOCKS}, d AS (SELECT doc_id, round(coalesce(sum(page_confidence::DECIMAL(20,12)) FILTER (n_blocks > 0)::DOUBLE / count(*) FILTER (n_blocks > 0), 0), 6) AS a FROM final_pages GROUP BY doc_id) SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN round(a + 0.01, 6) ELSE a END AS overall_confidence, CASE WHEN doc_id % 3 = 0 THEN 'other' ELSE 'primary' END AS engine_used FROM d")
def choose_document(spark, sf_dir):
    d = document_scores(spark, sf_dir).select("doc_id", "overall_confidence")
    better = F.when(F.col("doc_id") % 3 == 0, F.round(F.col("overall_confidence") + 0.01, 6)).otherwise(F.col("overall_confidence"))
    return quality.choose_document(d.withColumn("engine_used", F.lit("primary")), d.withColumn("overall_confidence", better).withColumn("engine_used", F.lit("other")))


@query(f"WITH {S.SQL_BLOCKS} SELECT doc_id, page_no, block_ord, bbox[1]::INT AS x1, trunc(bbox[2])::INT AS y1, bbox[3]::INT AS x2, trunc(bbox[4])::INT AS y2, CASE WHEN review THEN 'red' ELSE 'green' END AS color, block_type AS label_type FROM final_blocks")
def overlay_boxes(spark, sf_dir):
    return render.overlay(quality.score_blocks(S.blocks(spark, sf_dir))).withColumn("label_type", F.substring_index("label", ":", 1)).drop("label")


@query(f"WITH {S.SQL_BLOCKS} SELECT doc_id, page_no, block_id, array_to_string(list_sort(reasons || CASE WHEN confidence < 0.75 THEN ['low_confidence'] ELSE [] END), ',') AS reasons FROM final_blocks WHERE review OR confidence < 0.75")
def visual_review(spark, sf_dir):
    return compare.visual_review(quality.score_blocks(S.blocks(spark, sf_dir))).select("doc_id", "page_no", "block_id", F.array_join("review_reason", ",").alias("reasons"))


def _visual(spark, sf_dir):
    return compare.compare_visual(S.orders(spark, sf_dir).select("doc_id", "page_no"), quality.score_blocks(S.blocks(spark, sf_dir)))


_VISUAL = S.SQL_BLOCKS + ", visual AS (SELECT o.doc_id, o.page_no, count(b.block_id) AS n_review FROM orders_ o LEFT JOIN (SELECT * FROM final_blocks WHERE review OR confidence < 0.75) b ON o.doc_id = b.doc_id AND o.page_no = b.page_no GROUP BY o.doc_id, o.page_no), vp AS (SELECT *, CASE WHEN n_review = 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE - least(0.8::DOUBLE, n_review * 0.1::DOUBLE) END AS similarity, CASE WHEN n_review > 0 THEN 'needs_review' ELSE 'review_ok' END AS status FROM visual)"


@query(f"WITH {_VISUAL} SELECT doc_id, page_no, n_review, round(similarity, 6) AS similarity, status FROM vp")
def compare_visual(spark, sf_dir):
    return _visual(spark, sf_dir).withColumn("similarity", F.round("similarity", 6))


@query(f"WITH {_VISUAL}, d AS (SELECT doc_id, count(*) AS page_count, round(avg(similarity), 6) AS overall_similarity, count(*) FILTER (status IN ('mismatch', 'needs_review')) AS bad_pages FROM vp GROUP BY doc_id) SELECT *, CASE WHEN overall_similarity >= 0.97 THEN 'match' WHEN overall_similarity >= 0.85 THEN 'partial' ELSE 'attention_required' END AS summary_status FROM d")
def document_comparison(spark, sf_dir):
    pages = _visual(spark, sf_dir)
    out = compare.summarize(pages).withColumn("overall_similarity", F.round("overall_similarity", 6))
    return out.withColumn("summary_status", compare.summary_status(F.col("overall_similarity")))


_COVER = S.SQL_PAIRS + ", cover AS (SELECT *, len(list_intersect(s, o)) / len(s) AS similarity FROM tokens_)"


@query(f"WITH {_COVER} SELECT doc_id, 1 AS page_no, round(similarity, 6) AS similarity, CASE WHEN similarity >= 0.97 THEN 'match' WHEN similarity >= 0.85 THEN 'partial' ELSE 'mismatch' END AS status FROM cover")
def token_coverage(spark, sf_dir):
    return compare.compare_table_heavy(S.text_pairs(spark, sf_dir)).select("doc_id", "page_no", F.round("similarity", 6).alias("similarity"), "status")


_ESC = "replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"


@query(f"WITH {S.SQL_PAIRS}, firsts AS (SELECT doc_id, o, list_filter(string_split(source_text, ' '), lambda x, i: list_position(string_split(source_text, ' '), x) = i) AS t FROM tokens_) SELECT doc_id, array_to_string(list_transform(t, lambda x: CASE WHEN list_contains(o, x) THEN {_ESC.format('x')} ELSE '<del>' || {_ESC.format('x')} || '</del>' END), ' ') AS text_diff_html FROM firsts")
def token_diff(spark, sf_dir):
    return compare.compare_table_heavy(S.text_pairs(spark, sf_dir)).select("doc_id", "text_diff_html")


@query(f"WITH {S.SQL_ORDERS} SELECT doc_id, page_no, CASE WHEN page_no <= 2 THEN 'text ' || page_no ELSE '' END AS source_text FROM orders_")
def pages_by_position(spark, sf_dir):
    """Source pages join recognised pages by position, however either are numbered; a page without one has empty source text."""
    o = S.orders(spark, sf_dir).select("doc_id", "page_no")
    source = o.where("page_no <= 2").select("doc_id", (F.col("page_no") * 10).alias("page_no"), F.concat(F.lit("text "), "page_no").alias("source_text"))
    return compare.pair_pages(o, source)


@query(f"""WITH {S.SQL_LINES}, p AS (SELECT doc_id, page_no, string_agg(line, chr(10) ORDER BY line_ord) AS t FROM page_lines GROUP BY doc_id, page_no), d AS (SELECT doc_id, sum(len(t)) FILTER (page_no <= 3) > 30 AS has_text_layer FROM p GROUP BY doc_id),
    l AS (SELECT doc_id, page_no, line AS x FROM page_lines), g AS (SELECT doc_id, page_no, count(*) AS n, sum(regexp_matches(x, '{_HEAD}')::INT) * 45 + sum((len(regexp_extract_all(x, '{_NUM}')) >= 2)::INT) * 12 + sum((len(x) <= 12)::INT) * 3 + sum(regexp_matches(x, '^(?:\\d+\\.\\s*|[■☑#])')::INT) * 10 AS h FROM l GROUP BY ALL),
    k AS (SELECT doc_id, CASE WHEN count(*) FILTER (h >= 180) / count(*) >= 0.6 OR sum(h) / (count(*) * 100) >= 2.2 THEN 'table_heavy' WHEN sum(h) / (count(*) * 100) >= 1.2 OR count(*) FILTER (h >= 180) > 0 THEN 'mixed' ELSE 'text_heavy' END AS layout_type FROM g GROUP BY doc_id)
    SELECT doc_id, coalesce(has_text_layer, false) AS has_text_layer, CASE WHEN has_text_layer THEN 'text' ELSE 'image' END AS pdf_type, 'pdf' AS file_type, layout_type FROM d JOIN k USING (doc_id)""")
def document_profile(spark, sf_dir):
    """Whole profiles out of the pages' texts."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_ord", "line"))), lambda x: x.line), "\n")
    pages = S.page_lines(spark, sf_dir).groupBy("doc_id", "page_no").agg(text.alias("source_text"))
    return profiling.profile(pages).select("doc_id", "has_text_layer", "pdf_type", "file_type", "layout_type")


@query()
def sequence_similarity(spark, sf_dir):
    """Similarity and word diff of whole texts."""
    return compare.compare_text_layer(S.text_pairs(spark, sf_dir)).select("doc_id", "similarity", "status", "text_diff_html")


@query()
def match_blocks(spark, sf_dir):
    """Each page's blocks against its source lines."""
    lines = S.page_lines(spark, sf_dir).groupBy("doc_id", "page_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_ord", "line"))), lambda x: x.line).alias("lines"))
    return compare.match_blocks(lines.withColumn("similarity", F.lit(0.5)), quality.score_blocks(S.blocks(spark, sf_dir)))


_CLEAN = r"""trim(regexp_replace(regexp_replace(html, '(?i)\s*style\s*=\s*["''][^"'']*["'']', '', 'g'), '>\s+<', '><', 'g'))"""


@query(f"WITH {S.SQL_TABLES} SELECT orderkey, {_CLEAN} AS clean FROM tables")
def clean_tables(spark, sf_dir):
    return S.order_tables(spark, sf_dir).select("orderkey", H.clean_table(F.col("html")).alias("clean"))


@query(f"WITH {S.SQL_TABLES} SELECT orderkey, '<table><thead><tr><th>품목</th><th>수량</th><th>금액</th></tr></thead><tbody>' || plain || '</tbody></table>' AS html FROM tables")
def pipe_to_html(spark, sf_dir):
    return S.order_tables(spark, sf_dir).select("orderkey", H.pipe_table_to_html(F.col("markdown")).alias("html"))


@query(f"WITH {S.SQL_TABLES}, p AS (SELECT orderkey, n, '| item' || partkey || ' | ' || quantity || ' | ' || price || CASE WHEN max(n) OVER (PARTITION BY orderkey) >= 3 THEN ' |  |  |' ELSE ' |' END AS line, max(n) OVER (PARTITION BY orderkey) AS m FROM rows_) SELECT orderkey, CASE WHEN any_value(m) >= 3 THEN '| 품목 | 수량 | 금액 |  |  |' || chr(10) || '| --- | --- | --- | --- | --- |' ELSE '| 품목 | 수량 | 금액 |' || chr(10) || '| --- | --- | --- |' END || chr(10) || string_agg(line, chr(10) ORDER BY n) AS markdown FROM p GROUP BY orderkey")
def html_to_pipe(spark, sf_dir):
    return S.order_tables(spark, sf_dir).select("orderkey", tables.html_table_to_markdown("html").alias("markdown"))


@query(f"""WITH {S.SQL_TABLES}, r AS (SELECT orderkey, n, count(*) OVER (PARTITION BY orderkey) + 1 - n AS below, partkey, quantity, price FROM rows_)
    SELECT orderkey, '<table id="t"><tr><th colspan="2">품목</th><th>수량 &amp;</th></tr>' || string_agg('<tr>' || CASE WHEN n % 2 = 1 THEN CASE WHEN below >= 3 THEN '<td class="a" rowspan="3"><b>' || partkey || '</b> &lt;' WHEN below = 2 THEN '<td class="a" rowspan="2">' || partkey || '  &lt;' ELSE '<td class="a">' || partkey || '  &lt;' END || '</td>' ELSE '' END || '<td>' || quantity || '</td><td>' || price || '</td>' || CASE WHEN n % 5 = 0 THEN CASE WHEN n % 2 = 0 THEN '<td></td>' ELSE '' END ELSE '' END || '</tr>', '' ORDER BY n) || '</table>' AS html FROM r GROUP BY orderkey""")
def repair_nested_spans(spark, sf_dir):
    """Spans that overlap, run past the last row or not, in cells with tags, entities and attributes; empty cells at some rows' ends; rows in a body."""
    o = S.orders(spark, sf_dir).join(S.items(spark, sf_dir), "orderkey")
    first = F.when(F.col("n") % 2 == 1, F.concat(F.lit('<td class="a" rowspan="3"><b>'), "partkey", F.lit("</b> &lt;</td>"))).otherwise("")
    row = F.concat(F.lit("<tr x>"), first, F.lit("<td>"), "quantity", F.lit("</td>"), F.lit("<td>"), "price", F.lit("</td>"), F.when(F.col("n") % 5 == 0, "<td></td><td> </td>").otherwise(""), F.lit("</tr>"))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", row.alias("row")))), lambda x: x.row), "\n")
    t = o.groupBy("orderkey").agg(F.concat(F.lit('before <table id="t"><thead><tr><th colspan="2">품목</th><th>수량 &amp;</th></tr></thead><tbody>'), rows, F.lit("</tbody></table> after")).alias("html"))
    return t.select("orderkey", tables.repair_html_table("html").alias("html"))


@query(f"""WITH {S.SQL_TABLES} SELECT orderkey, '<table border="1" style="w:1"><tr><th>품목</th><th>수량</th><th>금액</th></tr>' || string_agg('<tr><td>item' || partkey || '</td><td style="color:red">' || quantity || '</td><td>' || price || '</td></tr>', '' ORDER BY n) || '</table>' AS html FROM rows_ GROUP BY orderkey""")
def repair_spans(spark, sf_dir):
    return S.order_tables(spark, sf_dir).select("orderkey", tables.repair_html_table("html").alias("html"))


@query(f"""WITH {S.SQL_TABLES}, x AS (SELECT orderkey, n_rows AS r, n_rows // 3 AS pads, html FROM tables) SELECT orderkey, round(((r + 1) * 2.0 + (3 * (r + 1) + 2 * pads) * 0.6 + 2 * 2.5 + len(regexp_extract_all(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[0-9A-Za-z가-힣]+')) * 0.2 + least(len(html), 4000) / 400.0 + 5.0 * (1 - 2 * pads / (3 * (r + 1) + 2 * pads)) + CASE WHEN pads = 0 THEN 3 ELSE 0 END)::DOUBLE, 6) AS score FROM x""")
def table_scores(spark, sf_dir):
    return S.order_tables(spark, sf_dir).select("orderkey", F.round(H.table_score(F.col("html"), F.lit(""), F.lit("")), 6).alias("score"))


@query(f"WITH {S.SQL_TABLES} SELECT orderkey, n_rows + 1 AS n_rows, 3 AS n_cols, 3 * (n_rows + 1) AS n_filled FROM tables")
def table_shape(spark, sf_dir):
    t = S.order_tables(spark, sf_dir)
    return t.select("orderkey", H.table_rows(F.col("html")).cast("long").alias("n_rows"), H.table_columns(F.col("html")).alias("n_cols"), F.size(H.table_cells(F.col("html"))).cast("long").alias("n_filled"))


_ORDER_SEGMENTS = S.SQL_ORDERS + """,
r AS (SELECT doc_id, page_no, 0 AS n, CASE WHEN orderkey % 3 = 0 THEN '<tr><th>구분</th><th>수량</th><th>금액</th><th>비율</th><th>계획</th><th>실적</th></tr>' ELSE '<tr><th>구분</th><th>수량</th><th>금액</th></tr>' END AS row, CASE WHEN orderkey % 3 = 0 THEN 6 ELSE 3 END AS c FROM orders_
    UNION ALL SELECT doc_id, page_no, n, '<tr><td>item' || partkey || '</td><td>' || quantity || '</td><td>' || price || '</td></tr>', 3 FROM orders_ JOIN items_ USING (orderkey)),
i AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY doc_id) AS m, lag(n) OVER w AS pn, lag(c) OVER w AS pc FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY page_no, n)),
s AS (SELECT *, sum((m >= 6 AND i >= 3 AND n = 0 AND (pn > 0 OR abs(c - pc) >= 3))::INT) OVER (PARTITION BY doc_id ORDER BY i) + 1 AS split_index FROM i),
g AS (SELECT doc_id AS table_id, split_index::INT AS split_index, '<table>' || string_agg(row, '' ORDER BY i) || '</table>' AS html FROM s GROUP BY ALL)"""


@query(f"WITH {_ORDER_SEGMENTS} SELECT table_id, split_index, count(*) OVER (PARTITION BY table_id)::INT AS split_count, html FROM g")
def split_tables(spark, sf_dir):
    return tables.split_tables(S.merged_tables(spark, sf_dir))


@query(f"WITH {S.SQL_TABLES}, x AS (SELECT orderkey, n_rows, n_rows // 3 AS pads FROM tables) SELECT orderkey, (2 * (n_rows + 1) + 2 * 3 * (n_rows + 1) + 4 * pads + 2)::BIGINT AS n_tokens, (3 * (n_rows + 1) + 2 * pads)::BIGINT AS n_cells FROM x")
def pubtab_sizes(spark, sf_dir):
    return datasets.pubtab(S.order_tables(spark, sf_dir)).select("orderkey", F.size("structure").cast("long").alias("n_tokens"), F.size("cells").cast("long").alias("n_cells"))


@query(f"""WITH {S.SQL_TABLES}, c AS (SELECT orderkey, n, n = max(n) OVER (PARTITION BY orderkey) AS last, ['item' || partkey, quantity, price] || CASE WHEN n % 3 = 0 THEN ['', ''] ELSE [] END AS t FROM rows_),
    u AS (SELECT orderkey, n, ['<tr>'] || flatten(list_transform(t, lambda x, i: CASE WHEN i = 1 AND last THEN ['<td>', '<rowspan=9>', '</rowspan>', '</td>'] ELSE ['<td>', '</td>'] END)) || ['</tr>'] AS s, list_transform(t, lambda x: '{{"tokens":' || to_json(regexp_extract_all(x, '.'))::VARCHAR || '}}') AS k FROM c),
    a AS (SELECT orderkey, flatten(list(s ORDER BY n)) AS s, flatten(list(k ORDER BY n)) AS k FROM u GROUP BY orderkey)
    SELECT '{{"filename":"table_' || orderkey || '.png","html":{{"structure":{{"tokens":' || to_json(['<tr>', '<th>', '</th>', '<th>', '</th>', '<th>', '</th>', '</tr>'] || s)::VARCHAR || '}},"cells":[' || array_to_string(['{{"tokens":["품","목"]}}', '{{"tokens":["수","량"]}}', '{{"tokens":["금","액"]}}'] || k, ',') || ']}}}}' AS value FROM a""")
def pubtab_json(spark, sf_dir):
    t = datasets.pubtab(S.order_tables(spark, sf_dir)).withColumn("filename", F.format_string("table_%d.png", "orderkey"))
    return datasets.pubtab_json(t)


_METRICS = S.SQL_TABLE_PAIRS + """,
m_ AS (SELECT orderkey, gt_rows::INT AS gt_rows, 3 AS gt_cols, len(gt)::INT AS gt_cells, len(pred)::INT AS pred_cells, len(list_filter(gt, lambda c: list_contains(pred, c)))::INT AS matched_cells, CASE WHEN orderkey % 5 = 0 THEN 2 ELSE 1 END AS pred_rows, len(p)::INT AS pred_cols FROM full_),
metrics AS (SELECT *, matched_cells / pred_cells AS p, matched_cells / gt_cells AS r FROM m_),
rounded AS (SELECT orderkey, gt_rows, pred_rows, gt_cols, pred_cols, gt_cells, pred_cells, matched_cells, round(p, 3) AS cell_precision, round(r, 3) AS cell_recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 3) AS cell_f1 FROM metrics)"""


@query(f"WITH {_METRICS} SELECT * FROM rounded")
def compare_tables(spark, sf_dir):
    return tables.compare_tables(S.table_pairs(spark, sf_dir)).drop("gt_html", "pred_html")


@query(f"WITH {_METRICS} SELECT count(*) AS samples, round(avg(cell_f1), 6) AS avg_cell_f1, round(avg(cell_precision), 6) AS avg_cell_precision, round(avg(cell_recall), 6) AS avg_cell_recall, count(*) FILTER (cell_f1 >= 0.7) AS ok, count(*) FILTER (cell_f1 >= 0.4 AND cell_f1 < 0.7) AS partial, count(*) FILTER (cell_f1 < 0.4) AS poor FROM rounded")
def evaluation_summary(spark, sf_dir):
    return tables.evaluation_summary(tables.compare_tables(S.table_pairs(spark, sf_dir)))


@query(f"WITH {S.SQL_TABLE_PAIRS} SELECT orderkey, CASE WHEN orderkey % 5 = 0 THEN 'native' ELSE 'html' END AS output_format FROM full_")
def output_formats(spark, sf_dir):
    return S.table_pairs(spark, sf_dir).select("orderkey", H.table_format(F.col("pred_html")).alias("output_format"))


@query(f"WITH {S.SQL_ORDERS}, z AS (SELECT doc_id, page_no, n, partkey, discount, row_number() OVER (PARTITION BY doc_id, page_no ORDER BY n) AS k, count(*) OVER (PARTITION BY doc_id, page_no) - (orderkey % 7 = 0)::INT AS m FROM orders_ JOIN items_ USING (orderkey)) SELECT doc_id, page_no, 'p' || page_no || '_t' || k AS block_id, 'item ' || partkey AS text, round(1.0 - discount, 6) AS confidence, 0.0::DOUBLE AS x0, n * 10.0::DOUBLE AS y0, partkey * 1.0::DOUBLE AS x1, n * 10.0::DOUBLE + 8 AS y1 FROM z WHERE k <= m")
def line_engine_blocks(spark, sf_dir):
    b = parsing.line_engine_blocks(S.line_json(spark, sf_dir))
    return b.select("doc_id", "page_no", "block_id", "text", F.round("confidence", 6).alias("confidence"), *[F.get("bbox", F.lit(i)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))])


_TITLE = r"^(#{1,6}\s+|[■☑]\s*|\d+\.\s*)"
_LAYOUT = rf"""found AS (SELECT page_id, list_transform(list_transform(regexp_extract_all(html, '(?s)<h1\b[^>]*>(.*?)</h1>', 1), lambda x: regexp_replace(x, '<[^>]+>', '', 'g')), lambda x, i: {{'k': 'doc_title', 'x': x, 'i': i - 1}})
    || list_transform(list_transform(regexp_extract_all(html, '(?s)<p\b[^>]*>(.*?)</p>', 1), lambda x: regexp_replace(x, '<[^>]+>', '', 'g')), lambda x, i: {{'k': 'text', 'x': x, 'i': i - 1}})
    || list_transform(list_transform(regexp_extract_all(html, '(?s)<li\b[^>]*>(.*?)</li>', 1), lambda x: regexp_replace(x, '<[^>]+>', '', 'g')), lambda x, i: {{'k': 'text', 'x': x, 'i': i - 1}}) AS b FROM pages),
each AS (SELECT page_id, unnest(b) AS e, unnest(range(len(b))) AS ord_ FROM found),
node AS (SELECT page_id, ord_, e.k AS raw_type, trim(regexp_replace(e.x, '\s+', ' ', 'g')) AS text, '' AS html, 0.5::DOUBLE + (e.i % 4) * 0.1::DOUBLE AS confidence, e.i || '.0,' || 2 * e.i || '.0,' || (e.i + 50) || '.0,' || (2 * e.i + 10) || '.0' AS bbox FROM each
    UNION ALL SELECT page_id, 1000000 + t, CASE WHEN t % 2 = 0 THEN 'table' ELSE 'text' END, CASE WHEN t % 2 = 0 THEN '' ELSE 'inner' END, CASE WHEN t % 2 = 0 THEN '<table><tr><td>a</td></tr><tr><td>b</td></tr></table>' ELSE '' END, CASE WHEN t % 2 = 0 THEN 0.8 ELSE 1.0 END, '0.0,0.0,10.0,10.0' FROM pages, range(4) r(t)),
ordered AS (SELECT page_id AS doc_id, row_number() OVER (PARTITION BY page_id ORDER BY ord_)::INT AS block_ord, raw_type, text, html, confidence, bbox, CASE WHEN html <> '' THEN 'table' WHEN raw_type = 'doc_title' OR regexp_matches(text, '{_TITLE}') THEN 'title' ELSE 'text' END AS block_type FROM node WHERE text <> '' OR html <> ''),
firsts AS (SELECT *, row_number() OVER (PARTITION BY doc_id, block_type, text[1:200], bbox ORDER BY block_ord) AS r FROM ordered),
layout AS (SELECT doc_id, 1 AS page_no, block_ord, 'p1_b' || block_ord AS block_id, block_type, bbox, text, html, '' AS markdown, confidence, raw_type, 'paddle_vl' AS source_engine FROM firsts WHERE r = 1)"""


@query(f"WITH {_LAYOUT} SELECT * FROM layout")
def layout_engine_blocks(spark, sf_dir):
    b = parsing.classify(parsing.explode_objects(S.page_json(spark, sf_dir)))
    return b.withColumn("bbox", F.array_join(F.col("bbox").cast("array<string>"), ","))


@query("SELECT page_id AS doc_id, 1 AS page_no, 600 AS width, 800 AS height, url AS source_image, 'img_path,input_img,res,width,img_w' AS unsorted, 'img_path,img_w,input_img,res,width' AS keys FROM pages")
def page_sizes(spark, sf_dir):
    p = parsing.page_sizes(S.page_json(spark, sf_dir))
    return p.select("doc_id", "page_no", "width", "height", "source_image", F.lit("img_path,input_img,res,width,img_w").alias("unsorted"), F.array_join("raw_top_level_keys", ",").alias("keys"))


def _md(spark, sf_dir):
    return parsing.markdown_blocks(S.page_json(spark, sf_dir).withColumns({"width": F.lit(600), "height": F.lit(800)}))


_MARKDOWN = rf"""part AS (SELECT page_id, regexp_split_to_array('# ' || array_to_string(list_transform(regexp_extract_all(html, '(?s)<h1\b[^>]*>(.*?)</h1>', 1), lambda x: regexp_replace(x, '<[^>]+>', '', 'g')), ' ') || chr(10) || chr(10)
    || array_to_string(list_transform(regexp_extract_all(html, '(?s)<p\b[^>]*>(.*?)</p>', 1), lambda x: regexp_replace(x, '<[^>]+>', '', 'g')), chr(10) || chr(10)), '\n\s*\n+') AS p FROM pages),
kept AS (SELECT page_id, list_filter(list_transform(p, lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS p FROM part),
para AS (SELECT page_id, unnest(range(1, len(p) + 1)) AS i, unnest(p) AS raw, unnest(list_concat(p[2:], [''])) AS following FROM kept
    UNION ALL SELECT page_id, 2000000, 'after', '' FROM pages),
line AS (SELECT *, trim(regexp_replace(regexp_replace(raw, '^(?:#{{1,6}}\s*|[■☑]\s*|\d+\.\s*)', ''), '\s+', ' ', 'g')) AS text, trim(regexp_replace(raw, '\s+', ' ', 'g')) AS norm FROM para),
md_ AS (SELECT page_id, i, CASE WHEN raw LIKE '#%' OR (NOT contains(raw, chr(10)) AND (regexp_matches(norm, '{_TITLE}') OR (len(norm) <= 40 AND (contains(lower(following), '<table') OR contains(following, '|')) AND (len(regexp_extract_all(norm, '{_NUM}')) <= 1 OR norm LIKE '%:')))) THEN 'title' ELSE 'text' END AS block_type, text, '' AS html, raw AS markdown, 0.82::DOUBLE AS confidence FROM line WHERE text <> ''
    UNION ALL SELECT page_id, 1000000, 'table', '', '<table><thead><tr><th>a</th><th>b</th></tr></thead><tbody><tr><td>1</td><td>2</td></tr></tbody></table>', '| a | b |' || chr(10) || '|---|---|' || chr(10) || '| 1 | 2 |', 0.88 FROM pages),
md AS (SELECT page_id AS doc_id, 1 AS page_no, row_number() OVER (PARTITION BY page_id ORDER BY i)::INT AS block_ord, 'p1_md' || row_number() OVER (PARTITION BY page_id ORDER BY i) AS block_id, block_type, text, html, markdown, confidence, '' AS raw_type, 'paddle_vl_markdown_fallback' AS source_engine FROM md_)"""


@query(f"WITH {_MARKDOWN} SELECT * FROM md")
def markdown_blocks(spark, sf_dir):
    return _md(spark, sf_dir).drop("bbox")


@query(f"""WITH {_LAYOUT}, {_MARKDOWN}, own AS (SELECT * EXCLUDE (bbox) FROM layout WHERE doc_id % 2 = 0 OR block_type = 'table'),
    flags AS (SELECT doc_id, bool_or(block_type = 'table') AS has_table, bool_or(block_type <> 'table') AS has_text, bool_or(block_type = 'title') AS has_title FROM own GROUP BY doc_id)
    SELECT * FROM own UNION ALL BY NAME SELECT md.* REPLACE (block_ord + 1000000 AS block_ord) FROM md JOIN flags USING (doc_id)
    WHERE (block_type = 'table' AND NOT has_table) OR (block_type <> 'table' AND NOT has_text) OR (block_type = 'title' AND NOT has_title)""")
def merged_blocks(spark, sf_dir):
    """Blocks of both ways; every second page's own blocks are tables alone, so that its markdown adds the rest."""
    own = parsing.classify(parsing.explode_objects(S.page_json(spark, sf_dir))).where("doc_id % 2 = 0 OR block_type = 'table'")
    return parsing.merge_markdown(own, _md(spark, sf_dir)).drop("bbox")


@query("WITH r AS (SELECT page_id AS doc_id, CASE WHEN page_id % 3 = 0 THEN '<table><tr><td>x</td></tr></table>' WHEN page_id % 3 = 1 THEN '<table><tr><td>y</td></tr></table>' END AS html FROM pages) SELECT doc_id, 1 AS page_no, 'p1_table1' AS block_id, html, 0.85::DOUBLE AS confidence FROM r WHERE html IS NOT NULL")
def table_engine_blocks(spark, sf_dir):
    raw = F.when(F.col("page_id") % 3 == 0, '{"html":{"a":"no","b":"<table><tr><td>x</td></tr></table>"}}').when(F.col("page_id") % 3 == 1, '{"res":{"table_res_list":[{"pred_html":"<table><tr><td>y</td></tr></table>"}]}}').otherwise('{"res":{"table_res_list":[]}}')
    p = S.read(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), F.lit(1).alias("page_no"), raw.alias("raw"), F.lit(600).alias("width"), F.lit(800).alias("height"))
    return parsing.table_engine_blocks(p).select("doc_id", "page_no", "block_id", "html", "confidence")


@query(f"WITH {S.SQL_BOXES} SELECT b.doc_id, b.page_no, word_ord, token FROM boxes b JOIN words w ON b.doc_id = w.doc_id AND b.page_no = w.page_no AND w.x0 >= b.x0 AND w.y0 >= b.y0 AND w.x1 <= b.x1 AND w.y1 <= b.y1")
def words_in_tables(spark, sf_dir):
    return geometry.words_in_boxes(S.table_boxes(spark, sf_dir), S.words(spark, sf_dir)).select("doc_id", "page_no", "word_ord", "token")


@query(f"WITH {S.SQL_WORDS} SELECT doc_id, page_no, word_ord, x0 * 2 AS x0, y0 * 0.5 AS y0, x1 * 2 AS x1, y1 * 0.5 AS y1, token FROM words WHERE token <> ''")
def scaled_words(spark, sf_dir):
    p = S.orders(spark, sf_dir).select("doc_id", "page_no", F.lit(600).alias("rect_w"), F.lit(800).alias("rect_h"), F.lit(1200).alias("width"), F.lit(400).alias("height"))
    return geometry.scale_words(S.words(spark, sf_dir), p)


@query(f"WITH {S.SQL_BOXES} SELECT doc_id, page_no, greatest(0, round_even(x0 * 2, 0)::INT - 24) AS \"left\", greatest(0, round_even(y0 * 2, 0)::INT - 24) AS top, least(1200, round_even(x1 * 2, 0)::INT + 24) AS \"right\", least(1600, round_even(y1 * 2, 0)::INT + 24) AS bottom, least(1200, round_even(x1 * 2, 0)::INT + 24) - greatest(0, round_even(x0 * 2, 0)::INT - 24) >= 160 AND least(1600, round_even(y1 * 2, 0)::INT + 24) - greatest(0, round_even(y0 * 2, 0)::INT - 24) >= 80 AS crop_ok FROM boxes")
def crop_boxes(spark, sf_dir):
    b = S.table_boxes(spark, sf_dir).withColumns({"img_w": F.lit(1200), "img_h": F.lit(1600)})
    return geometry.crop_box(b).select("doc_id", "page_no", "left", "top", "right", "bottom", "crop_ok")


@query(f"WITH {S.SQL_WORDS} SELECT doc_id, page_no, 'Order' AS title, min_by((y0 + y1) / 2, word_ord) AS anchor_y FROM words WHERE token LIKE '%Order%' GROUP BY doc_id, page_no")
def title_anchors(spark, sf_dir):
    titles = S.orders(spark, sf_dir).select("doc_id", "page_no", F.lit("1. Order").alias("title"))
    return geometry.title_anchors(titles, S.words(spark, sf_dir)).withColumn("title", F.lit("Order"))


_CORNER = S.SQL_BOXES + """, t AS (SELECT b.*, mx, my, x1 - x0 >= mx * 0.8::DOUBLE AND y1 - y0 >= my * 0.8::DOUBLE AS f FROM boxes b JOIN (SELECT doc_id, page_no, max(x1) AS mx, max(y1) AS my FROM words GROUP BY ALL) e USING (doc_id, page_no)), k AS (SELECT doc_id, page_no, CASE WHEN f THEN 0 ELSE x0 END AS a0, CASE WHEN f THEN 28 ELSE y0 END AS b0, CASE WHEN f THEN least(mx, 420) ELSE x0 + least((x1 - x0) * 0.15, 220) END AS a1, CASE WHEN f THEN least(my, 138) ELSE y0 + least((y1 - y0) * 0.18, 120) END AS b1 FROM t),
    h AS (SELECT k.doc_id, k.page_no, token, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy, word_ord FROM k JOIN words w ON k.doc_id = w.doc_id AND k.page_no = w.page_no AND (x0 + x1) / 2 BETWEEN a0 AND a1 AND (y0 + y1) / 2 BETWEEN b0 AND b1),
    d AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_no, token ORDER BY cx, cy, word_ord) AS r FROM h)"""


@query(f"WITH {_CORNER} SELECT k.doc_id, k.page_no, coalesce(string_agg(token, ',' ORDER BY cx, cy, word_ord), '') AS words FROM k LEFT JOIN (SELECT * FROM d WHERE r = 1) d ON k.doc_id = d.doc_id AND k.page_no = d.page_no GROUP BY k.doc_id, k.page_no")
def top_left_words(spark, sf_dir):
    t = S.table_boxes(spark, sf_dir).withColumn("anchor_y", F.lit(20.0))
    return geometry.top_left_words(t, S.words(spark, sf_dir)).select("doc_id", "page_no", F.array_join("words", ",").alias("words"))


def _layout(spark, sf_dir):
    """A title, a table and a title a page; boxes of titles are meaningful on every other page."""
    b = S.table_boxes(spark, sf_dir)
    cols = ["doc_id", "page_no", "block_ord", "block_type", "text", "x0", "y0", "x1", "y1", "width", "height"]
    good = F.col("page_no") % 2 == 0
    box = lambda y: {"x0": F.lit(0.0), "y0": F.when(good, F.lit(y)).otherwise(0.0), "x1": F.when(good, F.lit(300.0)).otherwise(10.0), "y1": F.when(good, F.lit(y + 90)).otherwise(10.0)}
    first = b.withColumns({"block_ord": F.lit(0), "block_type": F.lit("title"), "text": F.lit("1. Order"), **box(20.0)})
    last = b.withColumns({"block_ord": F.lit(2), "block_type": F.lit("title"), "text": F.lit("missing"), **box(600.0)})
    table = b.withColumns({"block_type": F.lit("table"), "text": F.lit("")})
    return first.select(cols).unionByName(table.select(cols)).unionByName(last.select(cols))


@query(f"WITH {S.SQL_BOXES}, g AS (SELECT *, x1 - x0 >= 160 AND y1 - y0 >= 80 AND (x1 - x0) * (y1 - y0) / 480000 < 0.92 AS good, page_no % 2 = 0 AS even FROM boxes) SELECT doc_id, page_no, CASE WHEN good THEN x0 ELSE 0 END AS \"left\", CASE WHEN good THEN y0 WHEN even THEN 118 ELSE 38 END::DOUBLE AS top, CASE WHEN good THEN x1 ELSE 600 END AS \"right\", CASE WHEN good THEN y1 WHEN even THEN 592 ELSE 800 END::DOUBLE AS bottom FROM g")
def table_regions(spark, sf_dir):
    anchors = geometry.title_anchors(S.orders(spark, sf_dir).select("doc_id", "page_no", F.lit("1. Order").alias("title")), S.words(spark, sf_dir))
    return geometry.estimate_boxes(_layout(spark, sf_dir), anchors).drop("block_ord")


@query(f"WITH {S.SQL_ORDERS}, c AS (SELECT doc_id, page_no, 'page_' || lpad(page_no::VARCHAR, 4, '0') || '_table_001.png' AS crop FROM orders_ WHERE page_no % 3 <> 0), f AS (SELECT doc_id, min_by(crop, page_no) AS any_ FROM c GROUP BY doc_id) SELECT o.doc_id, o.page_no, coalesce(c.crop, any_) AS crop FROM orders_ o LEFT JOIN c USING (doc_id, page_no) LEFT JOIN f USING (doc_id)")
def match_crops(spark, sf_dir):
    o = S.orders(spark, sf_dir)
    crops = o.where("page_no % 3 <> 0").select("doc_id", "page_no", F.lit(1).alias("crop_ord"), F.concat(F.lit("page_"), F.lpad(F.col("page_no").cast("string"), 4, "0"), F.lit("_table_001.png")).alias("crop"))
    t = o.select("doc_id", "page_no", F.lit(1).alias("table_ord"), F.concat(F.lit("p"), "page_no", F.lit("_b6")).alias("block_id"))
    return geometry.match_crops(t, crops).select("doc_id", "page_no", "crop")


@query(f"WITH {S.SQL_TABLES}, c AS (SELECT orderkey, {_CLEAN} AS response FROM tables WHERE len(html) >= 50), d AS (SELECT *, row_number() OVER (PARTITION BY response[1:200] ORDER BY orderkey) AS r FROM c) SELECT orderkey, response FROM d WHERE r = 1")
def training_samples(spark, sf_dir):
    s = S.samples(spark, sf_dir)
    t = datasets.table_samples(s.withColumn("block_id", F.col("orderkey").cast("string")))
    return datasets.distinct_samples(t.withColumn("orderkey", F.col("block_id").cast("long")), ["orderkey"]).select("orderkey", "response")


@query(f"WITH {S.SQL_TABLES}, h AS (SELECT orderkey, row_number() OVER (ORDER BY md5('42' || orderkey)) AS r, count(*) OVER () AS n FROM tables) SELECT orderkey, CASE WHEN r <= greatest(1, floor(n * 0.1)) THEN 'val' ELSE 'train' END AS split FROM h")
def split_samples(spark, sf_dir):
    return datasets.split_samples(S.samples(spark, sf_dir), F.col("orderkey")).select("orderkey", "split")


@query(f"WITH {S.SQL_TABLES} SELECT count(*) AS samples, count(*) - greatest(1, floor(count(*) * 0.1))::BIGINT AS train, greatest(1, floor(count(*) * 0.1))::BIGINT AS val FROM tables")
def split_counts(spark, sf_dir):
    return datasets.split_counts(datasets.split_samples(S.samples(spark, sf_dir), F.col("orderkey")))


_TEXTS = r"SELECT doc_id, trim(regexp_replace(text, '[\s]+', ' ', 'g')) AS norm, text FROM documents"


@query(rf"WITH t AS ({_TEXTS}) SELECT doc_id, norm AS normalized, len(regexp_extract_all(text, '{_NUM}'))::INT AS n_numbers, CASE WHEN len(norm) <= 220 THEN norm ELSE norm[1:217] || '...' END AS preview, replace({_ESC.format('text')}, chr(10), '<br />') AS safe, regexp_matches(norm, '^(#{{1,6}}\s+|[■☑]\s*|\d+\.\s*)') AS is_title, len(list_distinct(list_filter(string_split(norm, ' '), lambda x: x <> '')))::INT AS n_tokens FROM t")
def text_functions(spark, sf_dir):
    d = S.read(spark, sf_dir, "documents")
    t = F.col("text")
    return d.select("doc_id", X.normalize_space(t).alias("normalized"), X.count_numbers(t).alias("n_numbers"), X.truncate(t).alias("preview"), X.safe_html(t).alias("safe"), X.is_title(t).alias("is_title"), F.size(X.tokens(t)).alias("n_tokens"))


def _result(spark, sf_dir):
    blocks = quality.score_blocks(S.blocks(spark, sf_dir))
    pages = quality.score_pages(S.orders(spark, sf_dir).select("doc_id", "page_no"), blocks)
    docs = pages.select("doc_id").distinct().withColumn("source_file", F.concat(F.lit("doc"), "doc_id", F.lit(".pdf")))
    return docs, pages, blocks


@query(f"""WITH {S.SQL_BLOCKS}, l AS (SELECT doc_id, page_no, block_ord, CASE WHEN block_type = 'title' THEN '### ' || text WHEN block_type = 'table' THEN CASE WHEN coalesce(lag(block_type) OVER w = 'table', false) THEN chr(10) ELSE '' END || CASE WHEN html <> '' THEN html || chr(10) ELSE '' END WHEN text <> '' THEN text || chr(10) END AS line FROM final_blocks WINDOW w AS (PARTITION BY doc_id, page_no ORDER BY block_ord)),
    b AS (SELECT doc_id, page_no, string_agg(line, chr(10) ORDER BY block_ord) AS body FROM l WHERE line IS NOT NULL GROUP BY ALL),
    p AS (SELECT f.doc_id, f.page_no, '## Page ' || f.page_no || chr(10) || chr(10) || CASE WHEN page_confidence < 0.70 THEN '> review: low_page_confidence' || CASE WHEN n_blocks = 0 THEN ', page_without_blocks' ELSE '' END || chr(10) || chr(10) ELSE '' END || coalesce(body, '') AS o FROM final_pages f LEFT JOIN b ON f.doc_id = b.doc_id AND f.page_no = b.page_no)
    SELECT doc_id, regexp_replace('# doc' || doc_id || '.pdf' || chr(10) || chr(10) || string_agg(o, chr(10) ORDER BY page_no), '\\s+$', '') || chr(10) AS markdown FROM p GROUP BY doc_id""")
def render_markdown(spark, sf_dir):
    return render.render_markdown(*_result(spark, sf_dir))


_DIV = "'<div class=\"ocr-block' || CASE WHEN {0} THEN ' diff' ELSE '' END || '\" id=\"' || block_id || '\"><div class=\"label\"><span>' || block_type || ' / ' || block_id || '</span><span>conf=' || printf('%.3f', confidence) || '</span></div>' || CASE WHEN html <> '' THEN html WHEN block_type = 'title' THEN '<h4>' || text || '</h4>' ELSE '<div>' || text || '</div>' END || '</div>'"


@query(f"""WITH {S.SQL_BLOCKS}, b AS (SELECT doc_id, page_no, string_agg({_DIV.format("review")}, chr(10) ORDER BY block_ord) AS body FROM final_blocks GROUP BY ALL),
    p AS (SELECT f.doc_id, f.page_no, '<section class="page"><h2>Page ' || f.page_no || '</h2>' || coalesce(body, '') || '</section>' AS o FROM final_pages f LEFT JOIN b ON f.doc_id = b.doc_id AND f.page_no = b.page_no)
    SELECT doc_id, '<!doctype html><html><head><meta charset="utf-8"><title>doc' || doc_id || '.pdf</title></head><body><h1>doc' || doc_id || '.pdf</h1>' || string_agg(o, chr(10) ORDER BY page_no) || '</body></html>' AS html FROM p GROUP BY doc_id""")
def render_html(spark, sf_dir):
    return render.render_html(*_result(spark, sf_dir))


@query(f"""WITH {_VISUAL}, f AS (SELECT *, array_to_string(list_sort(reasons || CASE WHEN confidence < 0.75 THEN ['low_confidence'] ELSE [] END), ', ') AS why FROM final_blocks WHERE review OR confidence < 0.75),
    n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_no ORDER BY block_id) AS nth, count(*) OVER (PARTITION BY doc_id, page_no) AS n FROM f),
    i AS (SELECT doc_id, page_no, max(n) AS n, string_agg('<div class="block"><p><strong>' || block_id || '</strong> / ' || block_type || ' / status=needs_review / similarity=' || printf('%.3f', greatest(0, least(1, confidence))) || '</p>' || CASE WHEN why <> '' THEN '<p>reason: ' || why || '</p>' ELSE '' END || CASE WHEN text <> '' THEN '<p>ocr: ' || text || '</p>' ELSE '' END || '</div>', chr(10) ORDER BY nth) AS items FROM n WHERE nth <= 40 GROUP BY ALL),
    b AS (SELECT doc_id, page_no, string_agg({_DIV.format("review OR confidence < 0.75")}, chr(10) ORDER BY block_ord) AS body FROM final_blocks GROUP BY ALL),
    t AS (SELECT doc_id, page_no, string_agg(CASE WHEN text <> '' THEN text END, chr(10) ORDER BY block_ord) AS t FROM final_blocks GROUP BY ALL),
    p AS (SELECT v.*, coalesce(i.n, 0) AS n, items, coalesce(body, '<p>no blocks</p>') AS body, coalesce(t, '') AS ocr, trim(replace(coalesce(t, ''), chr(10), ' ')) AS flat FROM vp v LEFT JOIN i USING (doc_id, page_no) LEFT JOIN b USING (doc_id, page_no) LEFT JOIN t USING (doc_id, page_no)),
    o AS (SELECT *, CASE WHEN n > 0 THEN ' warn' ELSE '' END AS warn FROM p),
    h AS (SELECT doc_id, page_no, '<section class="page"><h2>Page ' || page_no || '</h2><div class="meta"><span class="badge">visual_only</span><span class="badge' || warn || '">similarity=' || printf('%.3f', similarity) || '</span><span class="badge' || warn || '">' || status || '</span><span class="badge' || warn || '">mismatches=' || n || '</span></div><div class="stats"><span class="badge">source_chars=0</span><span class="badge">ocr_chars=' || len(ocr)
        || '</span></div><div class="page-compare"><div class="page-viewer"><p>no image</p></div><div class="page-viewer"><div class="ocr-page">' || body || '</div></div></div><div class="panel"><p>no text layer: blocks to look at only</p></div><div class="grid"><div class="text-preview"></div><div class="text-preview">' || CASE WHEN len(flat) <= 4000 THEN flat ELSE flat[1:3997] || '...' END || '</div></div>'
        || CASE WHEN n > 0 THEN '<div class="blocks">' || items || CASE WHEN n > 40 THEN '<p class="hint">40 of ' || n || ' shown</p>' ELSE '' END || '</div>' ELSE '' END || '</section>' AS o FROM o),
    d AS (SELECT doc_id, round(avg(similarity), 6) AS s FROM vp GROUP BY doc_id), g AS (SELECT *, CASE WHEN s >= 0.97 THEN 'match' WHEN s >= 0.85 THEN 'partial' ELSE 'attention_required' END AS st, CASE WHEN s >= 0.97 THEN '' WHEN s >= 0.85 THEN ' warn' ELSE ' bad' END AS tone FROM d)
    SELECT doc_id, '<!doctype html><html><head><meta charset="utf-8" /><title>doc' || doc_id || '.pdf comparison</title></head><body><section class="summary"><h1>doc' || doc_id || '.pdf</h1><div class="meta"><span class="badge' || any_value(tone) || '">overall_similarity=' || printf('%.3f', any_value(s) + 1e-9) || '</span><span class="badge' || any_value(tone) || '">' || any_value(st) || '</span></div></section>' || string_agg(o, chr(10) ORDER BY page_no) || '</body></html>' AS html FROM h JOIN g USING (doc_id) GROUP BY doc_id""")
def render_comparison(spark, sf_dir):
    """The comparison of documents without a text layer: their pages, marked blocks and what to look at."""
    docs, pages, blocks = _result(spark, sf_dir)
    pages, found = compare.compare_documents(pages.select("doc_id", "page_no"), blocks)
    docs = docs.join(compare.summarize(pages), "doc_id").withColumn("overall_similarity", F.round("overall_similarity", 6))
    docs = docs.withColumn("summary_status", compare.summary_status(F.col("overall_similarity")))
    return render.render_comparison(docs, pages, found, blocks)


@query(f"WITH {S.SQL_TABLES} SELECT orderkey, CASE WHEN orderkey % 4 = 0 THEN 'skipped' WHEN orderkey % 4 = 1 THEN 'replaced' ELSE 'kept' END AS status, CASE WHEN orderkey % 4 = 0 THEN 'no_candidate' END AS reason, CASE WHEN orderkey % 4 = 1 THEN replace(html, '</table>', '<tr><td>a</td><td>b</td><td>c</td></tr></table>') ELSE html END AS html, CASE WHEN orderkey % 4 = 1 AND orderkey % 8 <> 1 THEN 'new text' ELSE 'old text' END AS text, CASE WHEN orderkey % 4 = 1 THEN 0.85 ELSE 0.8 END::DOUBLE AS confidence FROM tables")
def refine_tables(spark, sf_dir):
    """Candidates hold a further row for some tables and are equal for others; some have no text of their own."""
    t = S.order_tables(spark, sf_dir).withColumns({"block_ord": F.lit(1), "text": F.lit("old text"), "confidence": F.lit(0.8), "markdown": F.lit("")})
    more = F.replace("html", F.lit("</table>"), F.lit("<tr><td>a</td><td>b</td><td>c</td></tr></table>"))
    text = F.when(F.col("orderkey") % 8 == 1, "").otherwise("new text")
    c = t.where("orderkey % 4 <> 0").select("orderkey", F.lit(1).alias("candidate_ord"), F.when(F.col("orderkey") % 4 == 1, more).otherwise(F.col("html")).alias("html"), "markdown", text.alias("text"), F.lit(0.85).alias("confidence"))
    return tables.refine(t, c, ["orderkey"]).select("orderkey", "status", "reason", "html", "text", "confidence")


@query("SELECT page_id AS doc_id, 1 AS page_no, '<table><tr><td>a</td></tr><tr><td>b</td></tr></table>' AS html FROM pages")
def best_tables(spark, sf_dir):
    return parsing.best_table(parsing.explode_objects(S.page_json(spark, sf_dir)))


@query(f"WITH {S.SQL_BLOCKS} SELECT doc_id, page_no AS page, block_id, text AS response FROM blocks WHERE block_type IN ('text', 'title') AND len(trim(text)) >= 5")
def text_samples(spark, sf_dir):
    b = S.blocks(spark, sf_dir).withColumns({"image": F.lit("i"), "source": F.col("doc_id").cast("string")})
    return datasets.text_samples(b).select(F.col("source").cast("long").alias("doc_id"), "page", "block_id", "response")


@query(f"""WITH {S.SQL_BLOCKS}, b AS (SELECT *, list_distinct(string_split(text, ' ')) AS t FROM final_blocks WHERE text <> ''), g AS (SELECT doc_id, page_no, list_distinct(flatten(list(t))) AS o, CASE WHEN page_no % 3 = 0 THEN ['item'] ELSE ['item', '7', 'extra'] END AS s FROM b GROUP BY doc_id, page_no)
    SELECT doc_id, page_no, block_id, 1.0::DOUBLE AS similarity, 'match' AS status, array_to_string(reasons, ',') AS reasons, round(len(list_intersect(t, s)) / len(t), 6) AS source_coverage FROM b JOIN g USING (doc_id, page_no) WHERE review AND len(list_intersect(s, o)) / len(s) < 0.95""")
def covered_blocks(spark, sf_dir):
    """Flagged blocks of table-heavy pages whose sources are unlike them; every third page's source is one word that most pages have."""
    b = quality.score_blocks(S.blocks(spark, sf_dir))
    source = F.when(F.col("page_no") % 3 == 0, "item").otherwise("item 7 extra")
    pages = compare.compare_table_heavy(compare.page_texts(b).withColumn("source_text", source))
    return compare.covered_blocks(b, pages).select("doc_id", "page_no", "block_id", F.round("similarity", 6).alias("similarity"), "status", F.array_join("review_reason", ",").alias("reasons"), F.round("source_coverage", 6).alias("source_coverage"))


@query(f"""WITH {S.SQL_BLOCKS}, b AS (SELECT *, list_distinct(string_split(text, ' ')) AS t FROM final_blocks WHERE text <> ''), g AS (SELECT doc_id, page_no, list_distinct(flatten(list(t))) AS o FROM b GROUP BY doc_id, page_no), v AS (SELECT doc_id, page_no, count(*) AS n FROM final_blocks WHERE review OR confidence < 0.75 GROUP BY ALL),
    p AS (SELECT f.doc_id, f.page_no, f.doc_id % 3 = 0 AS layered, coalesce(len(list_intersect(['item', '7'], o)), 0) / 2 AS c, coalesce(v.n, 0) AS n FROM final_pages f LEFT JOIN g ON f.doc_id = g.doc_id AND f.page_no = g.page_no LEFT JOIN v ON f.doc_id = v.doc_id AND f.page_no = v.page_no)
    SELECT doc_id, page_no, CASE WHEN layered THEN 'text_layer_pdf' ELSE 'visual_only' END AS source_kind, round(CASE WHEN layered THEN c ELSE 1.0 - least(0.8::DOUBLE, n * 0.1::DOUBLE) END, 6) AS similarity, CASE WHEN layered THEN CASE WHEN c >= 0.97 THEN 'match' WHEN c >= 0.85 THEN 'partial' ELSE 'mismatch' END WHEN n > 0 THEN 'needs_review' ELSE 'review_ok' END AS status FROM p""")
def compare_documents(spark, sf_dir):
    """Every third document has a text layer and is table-heavy; the rest is looked at by eye."""
    b = quality.score_blocks(S.blocks(spark, sf_dir))
    pages = S.orders(spark, sf_dir).select("doc_id", "page_no")
    sources = pages.where("doc_id % 3 = 0").withColumn("source_text", F.lit("item 7"))
    profiles = sources.select("doc_id").distinct().withColumn("layout_type", F.lit("table_heavy"))
    found, _ = compare.compare_documents(pages, b, sources, profiles)
    return found.select("doc_id", "page_no", "source_kind", F.round("similarity", 6).alias("similarity"), "status")


def _spanned(spark, sf_dir):
    """A title and a table a page; the table's first row spans two rows over the words of its page."""
    b = S.table_boxes(spark, sf_dir)
    html = '<table><tr><th rowspan="2" colspan="2">qty</th><th rowspan="2">금액</th></tr><tr><td>1</td></tr><tr><td>2</td><td>3</td><td>4</td></tr></table>'
    cols = ["doc_id", "page_no", "block_ord", "block_type", "text", "html", "x0", "y0", "x1", "y1"]
    title = b.withColumns({"block_ord": F.lit(0), "block_type": F.lit("title"), "text": F.lit("1. Order"), "html": F.lit("")})
    return title.select(cols).unionByName(b.withColumns({"block_type": F.lit("table"), "text": F.lit(""), "html": F.lit(html)}).select(cols))


@query(f"""WITH {S.SQL_BOXES}, c AS (SELECT b.*, s.i, b.x0 + s.a * (b.x1 - b.x0) / 3 AS cx0, b.x0 + s.z * (b.x1 - b.x0) / 3 AS cx1, b.y0 + (b.y1 - b.y0) / 3 AS ry0, b.y0 + 2 * (b.y1 - b.y0) / 3 AS ry1 FROM boxes b, (VALUES (0, 0, 2), (1, 2, 3)) s(i, a, z)),
    h AS (SELECT DISTINCT c.doc_id, c.page_no, i FROM c JOIN words w ON c.doc_id = w.doc_id AND c.page_no = w.page_no AND w.x0 >= c.x0 AND w.y0 >= c.y0 AND w.x1 <= c.x1 AND w.y1 <= c.y1 AND (w.x0 + w.x1) / 2 BETWEEN cx0 AND cx1 AND (w.y0 + w.y1) / 2 BETWEEN ry0 AND ry1)
    SELECT c.doc_id, c.page_no, c.i AS cell_ord, CASE WHEN h.i IS NULL THEN 2 ELSE 1 END AS rowspan FROM c LEFT JOIN h ON c.doc_id = h.doc_id AND c.page_no = h.page_no AND c.i = h.i""")
def span_conflicts(spark, sf_dir):
    t = _spanned(spark, sf_dir).where("block_type = 'table'")
    cells = page_text.first_row_cells(t)
    shape = t.select("doc_id", "page_no", "block_ord", "x0", "y0", "x1", "y1", F.lit(3).alias("rows"), F.lit(3).alias("cols"))
    return geometry.span_conflicts(cells, S.words(spark, sf_dir), shape).select("doc_id", "page_no", "cell_ord", "rowspan")


_SPAN = "CASE WHEN hs[{0}] THEN '' ELSE ' rowspan=\"2\"' END"


@query(f"""WITH {_CORNER}, corner AS (SELECT k.doc_id, k.page_no, list(token ORDER BY cx, cy, word_ord) FILTER (token IS NOT NULL) AS w FROM k LEFT JOIN (SELECT * FROM d WHERE r = 1) d ON k.doc_id = d.doc_id AND k.page_no = d.page_no GROUP BY k.doc_id, k.page_no),
    s AS (SELECT b.*, w, coalesce(len(w) >= 2 AND w[-1] = 'qty' AND w[1] <> 'qty', false) AS split FROM boxes b JOIN corner USING (doc_id, page_no)),
    c AS (SELECT s.*, v.i, x0 + v.a * (x1 - x0) / 3 AS cx0, x0 + v.z * (x1 - x0) / 3 AS cx1, y0 + (y1 - y0) / 3 AS ry0, y0 + 2 * (y1 - y0) / 3 AS ry1 FROM s, (VALUES (false, 1, 0, 2), (false, 2, 2, 3), (true, 1, 0, 1), (true, 2, 1, 2), (true, 3, 2, 3)) v(sp, i, a, z) WHERE v.sp = s.split),
    hit AS (SELECT DISTINCT c.doc_id, c.page_no, i FROM c JOIN words w ON c.doc_id = w.doc_id AND c.page_no = w.page_no AND w.x0 >= c.x0 AND w.y0 >= c.y0 AND w.x1 <= c.x1 AND w.y1 <= c.y1 AND (w.x0 + w.x1) / 2 BETWEEN cx0 AND cx1 AND (w.y0 + w.y1) / 2 BETWEEN ry0 AND ry1),
    x AS (SELECT c.doc_id, c.page_no, any_value(split) AS split, any_value(w) AS w, list(hit.i IS NOT NULL ORDER BY c.i) AS hs FROM c LEFT JOIN hit ON c.doc_id = hit.doc_id AND c.page_no = hit.page_no AND c.i = hit.i GROUP BY c.doc_id, c.page_no)
    SELECT doc_id, page_no, '<table><tr>' || CASE WHEN split THEN '<th' || {_SPAN.format(1)} || '>' || w[1] || '</th><th' || {_SPAN.format(2)} || '>qty</th><th' || {_SPAN.format(3)} || '>금액</th>' ELSE '<th' || {_SPAN.format(1)} || ' colspan="2">qty</th><th' || {_SPAN.format(2)} || '>금액</th>' END || '</tr><tr><td>1</td></tr><tr><td>2</td><td>3</td><td>4</td></tr></table>' AS html, split OR list_contains(hs, true) AS pdf_text_repaired FROM x""")
def repair_from_words(spark, sf_dir):
    return page_text.repair_from_words(_spanned(spark, sf_dir), S.words(spark, sf_dir)).select("doc_id", "page_no", "html", "pdf_text_repaired")
