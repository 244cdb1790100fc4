"""The whole run over a folder of saved output."""

import json

import pytest
from pyspark.sql import functions as F

from parchment.plans.engine import REGISTRY, Config, Engine, SavedLayout, build, build_table_set, evaluate_tables, write
from parchment.sources import readers, writers


@pytest.fixture()
def folder(tmp_path):
    page = {"width": 600, "height": 800, "input_path": "x.png", "boxes": [
        {"type": "doc_title", "text": "Report", "bbox": [0, 0, 300, 40], "score": 0.9},
        {"type": "table", "html": "<table><tr><td>a</td><td>b</td></tr><tr><td>1</td><td>2</td></tr></table>", "bbox": [0, 50, 300, 200], "score": 0.95},
    ]}
    for n in (1, 2):
        d = tmp_path / "doc" / f"page_{n:04d}"
        d.mkdir(parents=True)
        (d / "res.json").write_text(json.dumps(page))
        (d / "res.md").write_text("# Report\n\nSome text.\n")
    return str(tmp_path / "doc")


def test_run(spark, folder, tmp_path):
    result = Engine(spark).run(readers.files(spark, folder))
    assert result["pages"].count() == 2 and result["documents"].first().engine_used == "paddle_vl"
    assert [(r.block_type, r.block_id) for r in result["blocks"].where("page_no = 1").orderBy("block_ord").collect()] == [("title", "p1_b1"), ("table", "p1_b2")]
    md = result["markdown"].first().markdown
    assert "### Report" in md and "<table><tr><td>a</td>" in md and "## Page 2" in md
    write(result, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out" / "blocks")).count() == 4


def test_sources(spark, folder):
    first = Engine(spark).run(readers.files(spark, folder))
    sources = first["pages"].selectExpr("doc_id", "page_no", "'Report a b 1 2' AS source_text")
    got = Engine(spark).run(readers.files(spark, folder), sources)["page_comparison"].first()
    assert got.similarity == 1.0 and got.status == "match"


def test_engines(spark):
    with pytest.raises(RuntimeError):
        Engine(spark, Config(engine="surya")).extractor()
    with pytest.raises(ValueError, match="paddle_vl"):
        build("other")
    with pytest.raises(NotImplementedError):
        build("surya").raw_pages(None)


def test_saved_results(spark, tmp_path):
    block = {"block_id": "p1_b1", "block_type": "table", "html": "<table>" + "<tr><td>x</td></tr>" * 4 + "</table>", "bbox": [0, 0, 1, 1], "confidence": 0.9}
    (tmp_path / "r.json").write_text(json.dumps({"document_id": "d", "source_file": "f", "pages": [{"page_no": 1, "source_image": "i.png", "blocks": [block]}]}, indent=1))
    blocks = readers.result_blocks(readers.results(spark, str(tmp_path / "r.json"))).withColumnRenamed("page", "p").drop("page_no").withColumnRenamed("p", "page_no")
    samples = build_table_set(blocks)
    assert [(r.split, r.prompt) for r in samples.collect()] == [("val", "Table Recognition:")]
    writers.save_splits(samples, str(tmp_path / "set"))
    assert readers.json_lines(spark, str(tmp_path / "set" / "split=val"), "response string").first().response.startswith("<table>")
    assert readers.count_lines(spark, str(tmp_path / "set" / "split=val")).first().lines == 1
    each, total = evaluate_tables(samples.selectExpr("response AS gt_html", "response AS pred_html"))
    assert total.first().ok == 1


def test_nest(spark):
    docs = spark.createDataFrame([(1,), (2,)], "doc_id int")
    pages = spark.createDataFrame([(1, 2), (1, 1)], "doc_id int, page_no int")
    blocks = spark.createDataFrame([(1, 1, 2, "b"), (1, 1, 1, "a")], "doc_id int, page_no int, block_ord int, text string")
    got = {r.doc_id: r.pages for r in writers.nest(docs, pages, blocks).collect()}
    assert got[2] is None and [p.page_no for p in got[1]] == [1, 2] and [b.text for b in got[1][0].blocks] == ["a", "b"]


def test_inbox(spark, folder, tmp_path):
    from parchment.streaming.inbox import watch

    seen = []
    for _ in range(2):
        watch(spark, folder, lambda df, i: seen.append(df.count()), str(tmp_path / "cp")).awaitTermination()
    assert sum(seen) == 4


def test_whole_run_with_text_layer(spark, folder):
    """Profiles route, words repair, comparisons go by the kind of document, and all of it is rendered."""
    files = readers.files(spark, folder)
    ids = build("paddle_vl").raw_pages(files).first().doc_id
    layer = "1. Report\n구분 수량 금액 10 20\n합계 30 40\n구분 합계 1 2\n" * 3
    sources = spark.createDataFrame([(ids, n, layer) for n in (1, 2)], "doc_id long, page_no int, source_text string")
    words = spark.createDataFrame([(ids, 1, 1, 10.0, 60.0, 40.0, 70.0, "a")], "doc_id long, page_no int, word_ord int, x0 double, y0 double, x1 double, y1 double, token string")
    new = "<table>" + "<tr><td>구분</td><td>수량</td></tr>" * 9 + "</table>"
    candidates = spark.createDataFrame([(ids, 1, "p1_b2", 1, new, "", "", 0.99)], "doc_id long, page_no int, block_id string, candidate_ord int, html string, markdown string, text string, confidence double")
    result = Engine(spark, Config(table_refine=True)).run(files, sources, candidates, words)
    profile = result["profiles"].first()
    assert (profile.layout_type, profile.has_text_layer, profile.routing_hint) == ("table_heavy", True, "prefer_paddle_vl")
    assert [(r.page_no, r.status) for r in result["refine_report"].orderBy("page_no").collect()] == [(1, "replaced"), (2, "skipped")]
    assert result["blocks"].where("page_no = 1 AND block_type = 'table'").first().html == new
    pages = result["page_comparison"].orderBy("page_no").collect()
    assert [p.source_kind for p in pages] == ["text_layer_pdf"] * 2 and all("<del>" in p.text_diff_html for p in pages) and 0 < pages[0].similarity < 0.85
    html = result["comparison_html"].first().html
    assert html.count('<section class="page">') == 2 and "similarity=" in html and "table_heavy" not in html


def test_text_heavy_documents_are_matched_line_by_line(spark, folder, monkeypatch):
    """And go to the engine for text, where engines can be chosen."""

    class Layout(SavedLayout):
        saved = False

    class Lines(Layout):
        name = "paddle_ocr"

    monkeypatch.setitem(REGISTRY, "paddle_vl", Layout)
    monkeypatch.setitem(REGISTRY, "paddle_ocr", Lines)
    files = readers.files(spark, folder)
    ids = build("paddle_vl").raw_pages(files).first().doc_id
    prose = "Repord\nan entirely different line of prose that the engine never saw at all\n"
    result = Engine(spark).run(files, spark.createDataFrame([(ids, 1, prose), (ids, 2, prose)], "doc_id long, page_no int, source_text string"))
    assert result["profiles"].first().layout_type == "text_heavy" and result["documents"].first().engine_used == "paddle_ocr"
    found = {(r.page_no, r.status) for r in result["mismatches"].collect()}
    assert {(1, "mismatch"), (2, "mismatch")} <= found
    assert set(result["mismatches"].columns) >= {"block_id", "source_text", "ocr_text", "review_reason"}


def test_written_results_are_read_again(spark, folder, tmp_path):
    from parchment.plans.engine import build_structure_set, write_results

    result = Engine(spark).run(readers.files(spark, folder))
    write_results(result, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out" / "result").glob("part-*"))
    assert '\n  "pages"' in text or '"pages" : [' in text
    blocks = result["blocks"].withColumns({"image": F.lit("i.png"), "source": F.lit("s")})
    rows = build_structure_set(blocks).orderBy("filename").collect()
    assert [r.filename for r in rows] == ["table_0000.png", "table_0001.png"] and {r.split for r in rows} == {"train", "val"} and '"tokens":["<tr>"' in rows[0].value


def test_command_line(spark, folder, tmp_path, monkeypatch):
    from parchment.__main__ import main

    main(["run", folder, "--output", str(tmp_path / "o"), "--engine", "paddle_vl", "--disable-table-refine", "--no-html"])
    assert spark.read.json(str(tmp_path / "o" / "blocks")).count() == 4 and not (tmp_path / "o" / "html").exists()
    (tmp_path / "pairs.jsonl").write_text("".join(json.dumps({"sample_idx": i, "gt_html": "<table><tr><td>a</td></tr></table>", "pred_html": "<table><tr><td>a</td></tr></table>"}) + "\n\n" for i in range(3)))
    main(["evaluate", str(tmp_path / "pairs.jsonl"), "--output", str(tmp_path / "e"), "--sample-idx", "1"])
    assert spark.read.json(str(tmp_path / "e" / "samples")).count() == 1
    with pytest.raises(SystemExit):
        main([])


def test_crops_in_order(spark, tmp_path):
    for n in ("b.png", "a.png", "c.txt"):
        (tmp_path / n).write_bytes(b"x")
    assert [(r.crop, r.crop_ord) for r in readers.crops(spark, str(tmp_path)).orderBy("crop_ord").collect()] == [("a.png", 1), ("b.png", 2)]
    assert readers.folders("/x/", "input") == "/x/input*"
