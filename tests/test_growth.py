"""Steps whose cost must not grow faster than their input."""

import time

from pyspark.sql import functions as F

from parchment.functions import html as H
from parchment.functions import text as X
from parchment.operators import compare, datasets, geometry, page_text, parsing, tables


def test_split_tables_reads_a_long_table_once(spark):
    head, row = "<tr><th>구분</th><th>수량</th><th>금액</th></tr>", "<tr><td>item1</td><td>2.00</td><td>3.00</td></tr>"
    odd = "<tr><td><b>합계</b></td><td>1</td><td>2</td></tr><tr><td>구<i></i>분</td><td>1</td><td>2</td></tr><tr><td> &lt;구분</td></tr>"
    html = "<table>" + (head + row * 9) * 300 + odd + "</table>"
    began = time.time()
    got = tables.split_tables(spark.createDataFrame([(1, html)], "table_id long, html string")).orderBy("split_index").collect()
    assert time.time() - began < 60 and len(got) == 300
    assert [r.html for r in got[:-1]] == ["<table>" + head + row * 9 + "</table>"] * 299 and got[-1].html == "<table>" + head + row * 9 + odd + "</table>"


def test_pubtab(spark):
    rows = datasets.pubtab(spark.createDataFrame([('<table><tr><TH rowspan="2">a&lt;</TH><td>b</td></tr><tr></tr></table>',), ("none",)], "html string")).collect()
    assert [(r.structure, r.cells) for r in rows] == [(["<tr>", "<th>", "<rowspan=2>", "</rowspan>", "</th>", "<td>", "</td>", "</tr>", "<tr>", "</tr>"], [["a", "<"], ["b"]])]


def test_table_columns_and_cells(spark):
    cases = [('<table><tr><td colspan="3">a</td><td><b> </b></td></tr><tr><td>x<i>y</i></td></tr></table>', 4, ["a", "xy"]), ("<tr></tr>", 0, []), ("<fcel>a</fcel><fcel> b</fcel><nl><fcel>c</fcel>", 2, ["a", "b", "c"]), ("", None, [])]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, html string").orderBy("i")
    assert [(r[0], r[1]) for r in df.select(H.table_columns(F.col("html")), H.table_cells(F.col("html"))).collect()] == [c[1:] for c in cases]


def test_grid_takes_no_time_for_places_that_no_cell_spans():
    assert tables.to_grid([[("a", 2, 1), ("b", 1, 2)], [("c", 1, 1)], [("d", 9, 0), ("e", 1, 9)]]) == [["a", "b", "", *[""] * 6], ["", "c", "", *[""] * 6], ["e", *[""] * 8]]
    began = time.time()
    assert len(tables.html_to_pipe("<table>" + '<tr><td rowspan="1" colspan="2">a</td><td>b|</td></tr>' * 20_000 + "</table>").split("\n")) == 20_001 and time.time() - began < 2


def test_strip_takes_off_what_normalize_space_takes_for_white_space(spark):
    rows = [(i, f"{chr(i)}a{chr(i)}b{chr(i)}") for i in range(1, 0x3100) if not 0xD800 <= i < 0xE000]
    got = spark.createDataFrame(rows, "i int, t string").select("i", X.strip(F.col("t")).alias("s"), X.normalize_space(F.col("t")).alias("n")).collect()
    assert [r.i for r in got if r.s != chr(r.i) + f"a{chr(r.i)}b" + chr(r.i)] == [r.i for r in got if r.n == "a b"]


def test_joins_of_words_do_not_sort_them(spark):
    words = spark.createDataFrame([(1, 1, 101 + i, 1.0, 1.0, 2.0, 2.0, "a") for i in range(3)], "doc_id long, page_no int, word_ord int, x0 double, y0 double, x1 double, y1 double, token string")
    page = spark.createDataFrame([(1, 1, 1, 1, 2, 2)], "doc_id long, page_no int, rect_w int, rect_h int, width int, height int")
    box = spark.createDataFrame([(1, 1, 1, 0.0, 0.0, 3.0, 3.0, None)], "doc_id long, page_no int, block_ord int, x0 double, y0 double, x1 double, y1 double, anchor_y double")
    cells = spark.createDataFrame([(1, 1, 1, 0, 2, 1)], "doc_id long, page_no int, block_ord int, cell_ord int, rowspan int, colspan int")
    shape = box.drop("anchor_y").withColumns({"rows": F.lit(2), "cols": F.lit(1), "y0": F.lit(-3.0)})
    hits = geometry.span_conflicts(cells, words, shape)
    for df in (geometry.scale_words(words, page), geometry.words_in_boxes(box, words), geometry.top_left_words(box, words), hits):
        assert "ShuffledHashJoin" in df._jdf.queryExecution().executedPlan().toString()
    assert [r.x1 for r in geometry.scale_words(words, page).collect()] == [4.0] * 3 and geometry.words_in_boxes(box, words).count() == 3 and [r.rowspan for r in hits.collect()] == [1]


def test_repair_from_words_works_its_tables_out_twice_at_most(spark):
    words = spark.createDataFrame([(1, 1, 101, 1.0, 1.0, 2.0, 2.0, "a")], "doc_id long, page_no int, word_ord int, x0 double, y0 double, x1 double, y1 double, token string")
    blocks = spark.createDataFrame([(1, 1, 1, "table", "", "<table></table>", 0.0, 0.0, 9.0, 9.0)], "doc_id long, page_no int, block_ord int, block_type string, text string, html string, x0 double, y0 double, x1 double, y1 double")
    df = page_text.repair_from_words(blocks, words)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Join ") <= 24 and [(r.html, r.pdf_text_repaired) for r in df.collect()] == [("<table></table>", False)]


def test_objects_are_handed_on_a_few_pages_at_a_time(spark):
    many = "[" + ",".join('{"type":"text","text":"t%d"}' % i for i in range(parsing.OBJECTS * 2)) + "]"
    pages = spark.createDataFrame([(1, 1, many), (2, 1, "no"), (3, 1, '{"type":"a"}')], "doc_id long, page_no int, raw string")
    df = parsing.explode_objects(pages.coalesce(1))
    assert "MapInArrow" in df._jdf.queryExecution().executedPlan().toString()
    rows = df.collect()
    assert [r.texts for r in rows] == [[f"t{i}"] for i in range(parsing.OBJECTS * 2)] + [[], []] and rows[-1].doc_id == 3


def test_lines_that_cannot_come_near_are_not_compared(monkeypatch):
    calls, real = [], compare.SequenceMatcher.ratio
    monkeypatch.setattr(compare.SequenceMatcher, "ratio", lambda m: calls.append(1) or real(m))
    lines = [f"item {i} qty 1.00" for i in range(12)]
    block = {"block_id": "b", "block_type": "text", "t": lines[0], "review": True, "review_reason": []}
    assert [x["similarity"] for x in compare.match_page(lines, [block])] == [1.0] and len(calls) <= 11
    calls.clear()
    assert compare.match_page(["구분"] * 12, [{**block, "t": "xyz"}])[0]["status"] == "extra_in_ocr" and not calls


def test_equal_texts_are_not_compared(monkeypatch):
    monkeypatch.setattr(compare, "SequenceMatcher", None)
    assert compare.ratio("a b", "a b") == 1.0 and compare.word_diff("a <b", "a  <b") == "a &lt;b"
