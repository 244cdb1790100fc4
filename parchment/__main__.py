"""Command line: run the engine over saved recognition output, build training sets, evaluate tables."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from parchment.plans import engine as E
from parchment.sources import readers, writers


def run(spark: SparkSession, given: argparse.Namespace) -> None:
    config = E.Config(
        engine=given.engine, save_markdown=not given.no_markdown, save_html=not given.no_html, save_comparison=not given.no_comparison, save_overlay=not given.no_overlay,
        table_refine=not given.disable_table_refine, table_refine_engine=given.table_refine_engine,
    )
    options = {
        "language": given.language, "device": given.device, "preprocess": not given.disable_preprocess, "merge_tables": not given.no_merge_cross_page_tables,
        "relevel_titles": not given.no_relevel_titles, "concatenate_pages": given.concatenate_pages, "table_refine_dpi": given.table_refine_dpi,
    }
    read = lambda path, schema: None if path is None else readers.json_lines(spark, path, schema)
    sources = read(given.sources, "doc_id long, page_no int, source_text string")
    words = read(given.words, "doc_id long, page_no int, word_ord int, x0 double, y0 double, x1 double, y1 double, token string")
    candidates = read(given.candidates, "doc_id long, page_no int, block_id string, candidate_ord int, html string, markdown string, text string, confidence double")
    result = E.Engine(spark, config, **options).run(readers.files(spark, given.input), sources, candidates, words)
    E.write(result, given.output, given.format)
    if given.pretty:
        E.write_results(result, f"{given.output}/documents_pretty")


def dataset(spark: SparkSession, given: argparse.Namespace) -> None:
    paths = [*given.input, *([readers.folders(given.root, given.prefix)] if given.root else [])]
    blocks = readers.result_blocks(readers.results(spark, paths)).drop("page_no").withColumnRenamed("page", "page_no")
    if given.kind == "structure":
        writers.save_splits(E.build_structure_set(blocks, given.ratio).select("value", "split"), given.output)
    else:
        writers.save_splits(E.build_table_set(blocks, given.ratio, given.max_samples), given.output)


def evaluate(spark: SparkSession, given: argparse.Namespace) -> None:
    pairs = readers.json_lines(spark, given.input, "sample_idx int, gt_html string, pred_html string")
    each, total = E.evaluate_tables(pairs, given.max_samples, given.sample_idx)
    E.write({"samples": each, "summary": total}, given.output)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="parchment", description=__doc__)
    sub = out.add_subparsers(dest="command")
    p = sub.add_parser("run", help="blocks, scores, comparison and rendered output of saved recognition output")
    p.add_argument("input", nargs="+", help="folders with saved output, a folder a page")
    p.add_argument("--output", "--output-dir", required=True)
    p.add_argument("--engine", default="auto", choices=["auto", *sorted(E.REGISTRY)])
    p.add_argument("--language", default="korean")
    p.add_argument("--device", default="gpu")
    for flag in ("--disable-preprocess", "--no-merge-cross-page-tables", "--no-relevel-titles", "--concatenate-pages", "--disable-table-refine", "--no-markdown", "--no-html", "--no-comparison", "--no-overlay", "--pretty"):
        p.add_argument(flag, action="store_true")
    p.add_argument("--table-refine-engine", default="table_recognition", choices=["paddle_vl", "paddle_ocr", "table_recognition"])
    p.add_argument("--table-refine-dpi", type=int, default=400)
    p.add_argument("--sources", help="JSON lines with pages of text layers")
    p.add_argument("--words", help="JSON lines with words of text layers")
    p.add_argument("--candidates", help="JSON lines with tables of a second engine")
    p.add_argument("--format", default="json", choices=["json", "parquet"])
    p.set_defaults(call=run)
    p = sub.add_parser("dataset", help="training sets out of saved results")
    p.add_argument("input", nargs="*", help="saved results")
    p.add_argument("--root", help="a folder whose folders with --prefix are read as well")
    p.add_argument("--prefix", default="")
    p.add_argument("--output", required=True)
    p.add_argument("--kind", default="tables", choices=["tables", "structure"])
    p.add_argument("--ratio", type=float, default=0.1)
    p.add_argument("--max-samples", type=int)
    p.set_defaults(call=dataset)
    p = sub.add_parser("evaluate", help="predicted tables against true ones")
    p.add_argument("input", nargs="+", help="JSON lines with sample_idx, gt_html and pred_html")
    p.add_argument("--output", required=True)
    p.add_argument("--max-samples", type=int)
    p.add_argument("--sample-idx", type=int)
    p.set_defaults(call=evaluate)
    return out


def main(args: list[str] | None = None) -> None:
    given = parser().parse_args(args)
    if not given.command:
        parser().error("a command is needed: run, dataset or evaluate")
    given.call(SparkSession.builder.appName("parchment").getOrCreate(), given)


if __name__ == "__main__":
    main()
