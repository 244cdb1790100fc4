"""Hand-written cases: limits, ties, nulls, empty input."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from parchment.functions import html as H
from parchment.functions import text as X
from parchment.operators import compare, datasets, geometry, parsing, profiling, quality, tables


def one(spark, expr, **values):
    row = spark.createDataFrame([tuple(values.values()) or (0,)], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double' if isinstance(v, float) else 'int'}" for k, v in values.items()) or "z int")
    return row.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "out"), [("a 　b\u0085\u001cc ", "a b c"), (None, ""), ("", ""), ("  x\n\ty ", "x y")])
def test_normalize_space(spark, text, out):
    assert one(spark, X.normalize_space(F.col("t")), t=text) == out


def test_text_functions(spark):
    assert one(spark, X.numbers(F.col("t")), t="a -1,234.5% 7 +2") == ["-1,234.5%", "7", "+2"]
    assert one(spark, X.safe_html(F.col("t")), t="<a&\"'\n>") == "&lt;a&amp;&quot;&#x27;<br />&gt;"
    assert len(one(spark, X.truncate(F.col("t")), t="x" * 221)) == 220 and one(spark, X.truncate(F.col("t")), t="x" * 220) == "x" * 220
    assert one(spark, X.count_data_numbers(F.col("t")), t="① 12 ② 5") == 2
    assert one(spark, X.tokens(F.col("t")), t="b a b  a c") == ["b", "a", "c"]
    assert one(spark, X.lines(F.col("t")), t="a \n\n b\r\nc") == ["a", "b", "c"]
    assert one(spark, X.html_path(F.col("t")), t="/x/source_pages/p.png") == "source_pages/p.png"


@pytest.mark.parametrize(("text", "next_", "title"), [("# a", "", True), ("1. a", "", True), ("short", "| a |", True), ("short", "text", False), ("x" * 41, "|", False), ("1 and 2", "|", False), ("1 and 2:", "|", True)])
def test_titles(spark, text, next_, title):
    assert one(spark, X.is_contextual_title(F.col("t"), F.col("n")), t=text, n=next_) is title


def test_similarity():
    assert compare.ratio("", "") == 1.0 and compare.ratio("a", "") == 0.0
    a, b = "ab " * 80, "ba " * 90
    assert compare.ratio(a, b) == SequenceMatcher(None, a, b).ratio()
    assert compare.word_diff("a b c", "a x c d") == "a <del>b</del> <ins>x</ins> c <ins>d</ins>"


@pytest.mark.parametrize(("value", "status"), [(0.97, "match"), (0.85, "partial"), (0.8499, "mismatch")])
def test_status(spark, value, status):
    assert one(spark, compare.page_status(F.col("s"), F.lit("a"), F.lit("b")), s=value) == status
    assert one(spark, compare.page_status(F.col("s"), F.lit(""), F.lit("")), s=value) == "empty"
    assert one(spark, compare.block_status(F.col("s"), F.lit("a"), F.lit("")), s=value) == "missing_in_ocr"


def test_coverage(spark):
    c = lambda a, b: one(spark, compare.coverage(X.tokens(F.col("a")), X.tokens(F.col("b"))), a=a, b=b)
    assert c("", "") == 1.0 and c("", "x") == 0.0 and c("x", "") == 0.0 and c("a b a", "b c") == 0.5


def test_match_page():
    block = {"block_id": "b1", "block_type": "text", "review": False, "review_reason": []}
    lines = ["alpha beta", "gamma delta", "unrelated ###"]
    assert [x["status"] for x in compare.match_page(lines, [{**block, "t": "alpha beta"}, {**block, "block_id": "b2", "t": "gamma delto"}])] == ["missing_in_ocr", "partial"]
    # A position beyond the last line goes back to all lines.
    assert compare.match_page(["a b c"], [{**block, "t": "a b c"}, {**block, "block_id": "b2", "t": "a b c"}]) == []
    assert compare.match_page([], [{**block, "t": "x"}])[0]["status"] == "extra_in_ocr"


def test_visual_floor(spark):
    schema = "doc_id int, page_no int, confidence double, review boolean, review_reason array<string>"
    blocks = spark.createDataFrame([(1, 1, 0.5, False, [])] * 9, schema)
    pages = spark.createDataFrame([(1, 1), (1, 2)], "doc_id int, page_no int")
    got = {r.page_no: (round(r.similarity, 9), r.status) for r in compare.compare_visual(pages, blocks).collect()}
    assert got == {1: (0.2, "needs_review"), 2: (1.0, "review_ok")}


BLOCKS = "doc_id int, page_no int, block_type string, text string, html string, markdown string, confidence double"


def test_block_scores(spark):
    rows = [(1, 1, "text", "7 7 7", "", "", 0.9), (1, 1, "table", "", "", "m", 0.9), (1, 2, "text", "", "", "", 0.9), (1, 3, "text", "x", "", "", 0.65), (1, 3, "text", None, "h", None, 1.7)]
    out = quality.score_blocks(spark.createDataFrame(rows, BLOCKS)).collect()
    assert [round(r.confidence, 6) for r in out] == [0.85, 0.7, 0.6, 0.65, 1.0]
    assert out[2].review and out[2].review_reason == ["empty_content", "low_block_confidence"] and not out[3].review
    pages = spark.createDataFrame([(1, 1), (1, 9)], "doc_id int, page_no int")
    got = {r.page_no: r for r in quality.score_pages(pages, quality.score_blocks(spark.createDataFrame(rows, BLOCKS))).collect()}
    assert got[9].page_confidence == 0 and got[9].review_reason == ["low_page_confidence", "page_without_blocks"] and got[9].needs_review
    doc = quality.score_documents(quality.score_pages(pages, quality.score_blocks(spark.createDataFrame(rows, BLOCKS)))).first()
    assert doc.overall_confidence == got[1].page_confidence and doc.review_required_pages == [9]


def test_page_threshold_is_strict(spark):
    out = quality.score_pages(spark.createDataFrame([(1, 1)], "doc_id int, page_no int"), quality.score_blocks(spark.createDataFrame([(1, 1, "text", "x", "", "", 0.6), (1, 1, "text", "x", "", "", 0.8)], BLOCKS))).first()
    assert out.page_confidence == 0.7 and "low_page_confidence" not in out.review_reason


@pytest.mark.parametrize(("html", "out"), [
    ("<table><tr><td>a</td></tr></table>", ""),
    ("<table><tr><td>a|b</td><td rowspan=2>c</td></tr><tr><td>d</td></tr></table>", "| a\\|b | c |\n| --- | --- |\n| d |  |"),
    ("<table><tr><td colspan='2'>a</td></tr><tr><td>b</td><td>&lt;c</td></tr></table>", "| a |  |\n| --- | --- |\n| b | <c |"),
    ("", ""), ("no table", ""),
])
def test_html_to_pipe(html, out):
    assert tables.html_to_pipe(html) == out


@pytest.mark.parametrize(("html", "out"), [
    ('<table><tr><td>a</td></tr><tr><td rowspan="3">b</td></tr></table>', "<table><tr><td>a</td></tr><tr><td>b</td></tr></table>"),
    ('<table><tr><td rowspan="5">a</td></tr><tr><td>b</td></tr></table>', '<table><tr><td rowspan="2">a</td></tr><tr><td>b</td></tr></table>'),
    ("<table><tr><td>a</td><td></td></tr><tr><td>b</td><td>c</td></tr></table>", "<table><tr><td>a</td><td></td></tr><tr><td>b</td><td>c</td></tr></table>"),
    ("<table><tr><td>a</td><td></td></tr><tr><td>b</td></tr></table>", "<table><tr><td>a</td></tr><tr><td>b</td></tr></table>"),
    ("plain", "plain"),
    ('<table class="x"><thead><tr id="r"><th rowspan=4 class="k">a &amp; <b>b</b></th><td>c<td></tr></thead><tr><td colspan="2"> </td><td></td></tr></table> tail', '<table class="x"><tr><th rowspan=2 class="k">a &amp;  b</th></tr><tr><td colspan="2"> </td></tr></table>'),
    ("<table><tr><td>a</td><td>b</td><td></td><td></td></tr><tr><td></td><td></td><td> <br/></td></tr></table>", "<table><tr><td>a</td><td>b</td></tr><tr><td></td><td></td></tr></table>"),
])
def test_repair(spark, html, out):
    assert spark.createDataFrame([(html,)], "html string").select(tables.repair_html_table("html").alias("t")).first().t == out


def test_null_tables(spark):
    df = spark.createDataFrame([(None,), ("",)], "html string")
    assert [tuple(r) for r in df.select(tables.html_table_to_markdown("html"), tables.repair_html_table("html"), H.clean_table(F.col("html")), H.pipe_table_to_html(F.col("html"))).collect()] == [("", "", "", "")] * 2


def test_pipe_table_with_escaped_pipe(spark):
    assert one(spark, H.pipe_table_to_html(F.col("t")), t="| a |\n|---|\n| x\\|y |\n") == "<table><thead><tr><th>a</th></tr></thead><tbody><tr><td>x\\</td><td>y</td></tr></tbody></table>"


def rows_html(*rows):
    return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"


@pytest.mark.parametrize(("rows", "parts"), [
    ([["구분"], ["1", "2"], ["구분"], ["1", "2"], ["3", "4"]], 1),
    ([["a"], ["b"], ["구분", "x", "y", "z"], ["1", "2"], ["3", "4"], ["5", "6"]], 1),
    ([["a"], ["1", "2"], ["3", "4"], ["구분"], ["3", "4"], ["5", "6"]], 2),
    ([["a"], ["1", "2"], ["3", "4"], ["합계", "수량", "금액", "x", "y"], ["3", "4"], ["5", "6"]], 1),
])
def test_split(spark, rows, parts):
    out = tables.split_tables(spark.createDataFrame([(1, rows_html(*rows))], "table_id int, html string"))
    assert out.count() == parts


def test_compare_tables(spark):
    df = spark.createDataFrame([(rows_html(["x"] * 5), rows_html(["x"])), ("", "")], "gt_html string, pred_html string")
    a, b = tables.compare_tables(df).collect()
    assert (a.cell_precision, a.cell_f1) == (5.0, 1.667) and (b.cell_f1, b.gt_cols) == (0.0, None)
    assert tables.compare_tables(df, bounded=True).first().cell_precision == 1.0


def test_refine_keeps_on_tie(spark):
    t = spark.createDataFrame([(1, 1, 1, rows_html(["a"], ["b"]), "", "", 0.5)], "doc_id int, page_no int, block_ord int, html string, markdown string, text string, confidence double")
    c = t.withColumn("candidate_ord", F.lit(1))
    assert tables.refine(t, c.select("doc_id", "candidate_ord", "html", "markdown", "text", "confidence"), ["doc_id"]).first().status == "kept"


def test_boxes(spark):
    box = lambda b: one(spark, geometry.overlay_box(F.array(*map(F.lit, map(float, b)))))
    assert box([1.9, 2.9, 3, 4]) == [1, 2, 3, 4] and box([5, 1, 9, 1, 9, 7, 5, 7]) == [5, 1, 9, 7] and box([1, 2, 3]) == [0, 0, 10, 10]
    assert parsing._box([5, 5, 1, 9]) == [0, 0, 10, 10] and parsing._box([[1, 2], [5, 2], [5, 9]]) == [1, 2, 5, 9] and parsing._box(None) == [0, 0, 10, 10]


def raw(spark, *pages):
    import json

    return spark.createDataFrame([(1, i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(pages, 1)], "doc_id long, page_no int, raw string")


def test_layout_json(spark):
    page = {"boxes": [
        {"type": "text", "text": "same", "content": "also", "score": 1.7, "bbox": [0, 0, 50, 50]},
        {"label": "text", "text": "same", "bbox": [0, 0, 50, 50]},
        {"type": "table", "html": "<table><tr><td>1</td></tr></table>", "bbox": [0, 0, 9, 9]},
        {"type": "table", "html": "<table><tr><td>2</td></tr></table>", "bbox": [0, 0, 9, 9]},
        {"text": "no kind, no box"}, {"type": "Title", "text": "x"}, {"type": "text", "texts": ["a", "", "b"], "score": True},
    ]}
    got = parsing.classify(parsing.explode_objects(raw(spark, page, "not json", {}))).orderBy("block_ord").collect()
    assert [(r.block_id, r.block_type, r.text, r.confidence) for r in got] == [("p1_b1", "text", "same", 1.0), ("p1_b3", "table", "", 0.8), ("p1_b5", "title", "x", 0.8), ("p1_b6", "text", "a b", 1.0)]


def test_longest_text_first_of_ties(spark):
    assert one(spark, parsing.best_text(F.array(F.lit("ab"), F.lit("cd"), F.lit(" e ")), F.lit(""))) == "ab"
    assert one(spark, parsing.best_text(F.array(F.lit("x <TABLE>")), F.lit(""))) == ""


def test_line_engine_stops_at_shortest(spark):
    p = {"rec_texts": ["a", "b"], "rec_scores": [0.5], "dt_polys": [[[0, 0], [2, 0], [2, 3]], [[0, 0]]]}
    got = parsing.line_engine_blocks(raw(spark, p, {})).collect()
    assert [(r.block_id, r.text, r.bbox) for r in got] == [("p1_t1", "a", [0.0, 0.0, 2.0, 3.0])]


def test_markdown_blocks(spark):
    md = "# Head\n\nshort\n\n| a | b |\n|---|---|\n| 1 | 2 |\n\ntail text\n\n<table><tr><td>x</td></tr></table>"
    df = spark.createDataFrame([(1, 1, md, 10, 20), (1, 2, "", 10, 20), (1, 3, None, 10, 20)], "doc_id long, page_no int, markdown string, width int, height int")
    got = parsing.markdown_blocks(df).orderBy("page_no", "block_ord").collect()
    assert [(r.block_type, r.text) for r in got] == [("title", "Head"), ("text", "short"), ("table", ""), ("text", "tail text"), ("table", "")]
    assert got[2].html.startswith("<table><thead>") and got[4].html.startswith("<table><tr>")


def test_text_layer_limit(spark):
    pages = spark.createDataFrame([(1, 1, "x" * 30), (2, 1, "x" * 31), (3, 4, "x" * 99)], "doc_id int, page_no int, text string")
    assert {r.doc_id: r.pdf_type for r in profiling.text_layer(pages).collect()} == {1: "image", 2: "text", 3: "image"}


def test_forced_engine(spark):
    p = spark.createDataFrame([("text_heavy", "prefer_paddle_ocr", "pdf", "text")], "layout_type string, routing_hint string, file_type string, pdf_type string")
    assert profiling.select_engine(p, {"paddle_vl": True}).first().engine == "paddle_vl"
    assert profiling.select_engine(p, {"paddle_vl": True}, "surya").first().engine is None


@pytest.mark.parametrize(("n", "val"), [(0, 0), (1, 1), (25, 2)])
def test_split_sizes(spark, n, val):
    df = spark.createDataFrame([(i,) for i in range(n)], "k int")
    assert datasets.split_counts(datasets.split_samples(df, F.col("k"))).first().val == val


def test_empty_tables(spark):
    e = spark.createDataFrame([], BLOCKS + ", block_ord int, block_id string, bbox array<double>")
    assert quality.score_blocks(e).count() == 0 and tables.split_merged_blocks(e).count() == 0
    assert parsing.classify(parsing.explode_objects(spark.createDataFrame([], "doc_id long, page_no int, raw string"))).count() == 0


def test_repair_from_words(spark):
    from parchment.operators.page_text import lower_spans, repair_from_words

    html = '<table><tr><th rowspan="2" colspan="2">B</th><th rowspan="2">C</th></tr><tr><td>x</td></tr></table>'
    blocks = spark.createDataFrame([(1, 1, 1, "table", "", html, 0.0, 0.0, 300.0, 100.0)], "doc_id int, page_no int, block_ord int, block_type string, text string, html string, x0 double, y0 double, x1 double, y1 double")
    words = spark.createDataFrame([(1, 1, 1, 5.0, 2.0, 15.0, 10.0, "A"), (1, 1, 2, 20.0, 2.0, 40.0, 10.0, "B"), (1, 1, 3, 250.0, 60.0, 280.0, 70.0, "under")], "doc_id int, page_no int, word_ord int, x0 double, y0 double, x1 double, y1 double, token string")
    got = repair_from_words(blocks, words).first()
    assert got.html == '<table><tr><th rowspan="2">A</th><th rowspan="2">B</th><th>C</th></tr><tr><td>x</td></tr></table>' and got.pdf_text_repaired
    assert not repair_from_words(blocks, words.limit(0)).first().pdf_text_repaired
    assert lower_spans("<table></table>", [0]) == "<table></table>"


def test_best_table(spark):
    page = {"a": {"html": "<table>1</table>"}, "b": {"md": "| a | b |\n|---|---|\n| 1 | 2 |\n"}}
    got = parsing.best_table(parsing.explode_objects(raw(spark, page, {}))).orderBy("page_no").collect()
    assert got[0].html.startswith("<table><thead>") and got[1].html == ""


def test_line_engine_items(spark):
    box = "[[0,0],[4,0],[4,2],[0,2]]"
    plain = f'{{"rec_texts":["a","b"],"rec_scores":[0.5,null],"dt_polys":[{box},{box}]}}'
    inner = f'{{"rec_texts":["old"],"res":{{"rec_texts":["c"],"rec_scores":[0.25]}},"_res":{{"dt_polys":[{box}]}}}}'
    rows = [(1, 1, f"[{plain},{inner}]"), (2, 1, inner), (3, 1, '{"rec_texts":["x"]}'), (4, 1, "no json"), (5, 1, None), (6, 1, "[]")]
    got = parsing.line_engine_blocks(spark.createDataFrame(rows, "doc_id int, page_no int, raw string")).orderBy("doc_id", "block_ord").collect()
    assert [(r.doc_id, r.block_id, r.text, r.confidence) for r in got] == [(1, "p1_t1", "a", 0.5), (1, "p1_t2", "b", 0.75), (1, "p1_t3", "c", 0.25), (2, "p1_t1", "c", 0.25)]


def whole_page(lines, blocks, with_source_only):
    """What is reported of a page, rule by rule."""
    ratio = lambda a, b: float(a == b) if not a or not b else SequenceMatcher(None, a, b).ratio()
    at, used, out = 0, [], []
    for b in blocks:
        window = list(range(len(lines)))[at : at + 12] or list(range(len(lines)))
        scores = [(ratio(lines[i], b["t"]), -i) for i in window]
        best, i = max(scores, default=(0.0, 0))
        if best > 0:
            at, source = 1 - i, lines[-i]
            used.append(-i)
        else:
            best, source = 0.0, ""
        status = "extra_in_ocr" if not source else "match" if best >= 0.97 else "partial" if best >= 0.85 else "mismatch"
        if b["review"] or status != "match":
            out.append((status, b["block_id"], round(best, 9), source))
    for i, line in enumerate(lines):
        if with_source_only and i not in used and all(ratio(line, b["t"]) < 0.55 for b in blocks):
            out.append(("missing_in_ocr", f"source_line_{len(out) + 1}", round(max((ratio(line, b["t"]) for b in blocks), default=0.0), 9), line))
    return sorted(out)


@pytest.mark.parametrize("seed", range(12))
def test_whole_pages_against_the_rules(seed):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "계획", "실적", "10", "20"]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 30))]
    blocks = []
    for n in range(rng.randint(0, 25)):
        t = rng.choice(lines) if lines and rng.random() < 0.7 else " ".join(rng.choice(words) for _ in range(3))
        t = t.replace("a", "o", rng.choice([0, 0, 1, 3]))
        blocks.append({"block_id": f"p1_b{n + 1}", "block_type": "text", "t": t, "review": rng.random() < 0.2, "review_reason": ["r"]})
    for only in (True, False):
        got = compare.match_page(lines, blocks, only)
        assert [(x["status"], x["block_id"], round(x["similarity"], 9), x["source_text"]) for x in got] == whole_page(lines, blocks, only)
