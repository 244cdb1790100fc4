"""The whole run over documents, and the extension point for recognition engines.

Pixels, PDFs and models stay outside: an extractor turns files into raw pages. What follows is one
plan a table.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.operators import compare, datasets, page_text, parsing, profiling, quality, render, tables
from parchment.sources import writers
from parchment.sources.shared import SharedFolder

#: Engines in the order in which auto falls back on them.
AUTO = ("paddle_vl", "paddle_ocr", "surya")


class Extractor(ABC):
    """A recognition engine: named, available or not, and a plan from files to raw pages.

    raw_pages takes rows of the binaryFile source (path, content, …) and gives (doc_id, page_no, raw, markdown); by mapInPandas
    where a library has to run, so that files are spread over executors and a batch is in memory at a time.
    """

    name: str
    #: Whether it reads what one engine has saved, so that there is no engine to choose.
    saved = False

    def __init__(self, **options):
        self.options = options

    @abstractmethod
    def available(self) -> bool: ...

    @abstractmethod
    def raw_pages(self, files: DataFrame) -> DataFrame: ...

    def blocks(self, pages: DataFrame) -> DataFrame:
        """Typed blocks of raw pages; layout JSON unless an engine says otherwise."""
        return parsing.classify(parsing.explode_objects(pages), self.name)


class SavedLayout(Extractor):
    """Output of the layout engine that was saved before: JSON and markdown a page."""

    name = "paddle_vl"
    saved = True

    def available(self) -> bool:
        return True

    def raw_pages(self, files: DataFrame) -> DataFrame:
        found = parsing.raw_pages(files.select("path", F.col("content").cast("string").alias("value")))
        page = F.coalesce(F.nullif(F.regexp_extract("page_dir", r"(\d+)$", 1), F.lit("")).cast("int"), F.lit(1))
        return found.select(F.xxhash64(F.regexp_replace("page_dir", r"/[^/]*$", "")).alias("doc_id"), page.alias("page_no"), "raw", "markdown")


class SavedLines(SavedLayout):
    """Output of the line engine that was saved before."""

    name = "paddle_ocr"

    def blocks(self, pages: DataFrame) -> DataFrame:
        return parsing.line_engine_blocks(pages).withColumn("raw_type", F.lit(""))


class SavedTables(SavedLayout):
    """Output of the table engine that was saved before."""

    name = "table_recognition"

    def blocks(self, pages: DataFrame) -> DataFrame:
        sized = pages.join(parsing.page_sizes(pages).select("doc_id", "page_no", "width", "height"), ["doc_id", "page_no"])
        return parsing.table_engine_blocks(sized).withColumn("raw_type", F.lit("table"))


class Unavailable(Extractor):
    """An engine that can be named but not run."""

    name = "surya"

    def available(self) -> bool:
        return False

    def raw_pages(self, files: DataFrame) -> DataFrame:
        raise NotImplementedError(f"{self.name} is not implemented")


REGISTRY: dict[str, Callable[..., Extractor]] = {x.name: x for x in (SavedLayout, SavedLines, SavedTables, Unavailable)}


def register(factory: Callable[..., Extractor], name: str) -> None:
    REGISTRY[name] = factory


def build(name: str, **options) -> Extractor:
    """The engine by its name, or an error that says which there are."""
    if name not in REGISTRY:
        raise ValueError(f"no engine {name!r}; there are {', '.join(sorted(REGISTRY))}")
    return REGISTRY[name](**options)


@dataclass(frozen=True)
class Config:
    engine: str = "auto"
    review: quality.Review = field(default_factory=quality.Review)
    save_markdown: bool = True
    save_html: bool = True
    save_comparison: bool = True
    save_overlay: bool = True
    table_refine: bool = False
    table_refine_engine: str = "table_recognition"
    max_tables_per_page: int = 8


class Engine:
    """run(files) -> tables by name: profiles, pages, blocks, documents, comparisons and rendered output.

    options go to the extractors as they are; those for saved output need none.
    """

    def __init__(self, spark: SparkSession, config: Config | None = None, **options):
        self.spark, self.config, self.options = spark, config or Config(), options

    def extractor(self) -> Extractor:
        """The engine asked for, if it is there; under auto the first available of layout, lines and others."""
        if self.config.engine != "auto":
            found = build(self.config.engine, **self.options)
            if not found.available():
                raise RuntimeError(f"engine {found.name} is not available")
            return found
        for name in AUTO:
            if name in REGISTRY and (found := build(name, **self.options)).available():
                return found
        raise RuntimeError("no engine is available")

    def routed(self, files: DataFrame, profiles: DataFrame | None) -> list[tuple[Extractor, DataFrame]]:
        """Each engine with the raw pages of the documents that go to it: by their profiles under auto, all to one engine otherwise.

        Documents without a profile go to the engine that extractor() names; so do all if it reads saved output.
        """
        first = self.extractor()
        if profiles is None or self.config.engine != "auto" or first.saved:
            return [(first, first.raw_pages(files))]
        there = {name: name in REGISTRY and build(name, **self.options).available() for name in AUTO}
        chosen = profiling.select_engine(profiles, there).select("doc_id", "engine")
        out = []
        for name in (x for x in AUTO if there[x]):
            own = build(name, **self.options)
            raw = own.raw_pages(files).join(chosen, "doc_id", "left")
            out.append((own, raw.where(F.coalesce("engine", F.lit(first.name)) == name).drop("engine")))
        return out

    def parse(self, raw: DataFrame, extractor: Extractor) -> DataFrame:
        """Blocks of raw pages: parsed, merged tables cut, markdown filled in, spans repaired, then what the page's markdown adds."""
        blocks = tables.repair_tables(tables.fill_markdown(tables.split_merged_blocks(extractor.blocks(raw))))
        sizes = parsing.page_sizes(raw).select("doc_id", "page_no", "width", "height")
        fallback = parsing.markdown_blocks(raw.where("markdown != ''").select("doc_id", "page_no", "markdown").join(sizes, ["doc_id", "page_no"]))
        kept = [c for c in blocks.columns if c in fallback.columns]
        return parsing.merge_markdown(blocks.select(kept), fallback.select(kept))

    def run(self, files: DataFrame, sources: DataFrame | None = None, candidates: DataFrame | None = None, words: DataFrame | None = None) -> dict[str, DataFrame]:
        """files: binaryFile rows; sources: (doc_id, page_no, source_text) of the documents that have a text layer; words: (doc_id, page_no, x0, y0, x1,
        y1, token) of text layers, scaled to the pages; candidates: tables of a second engine to refine with."""
        profiles = None if sources is None else profiling.profile(sources)
        parts = self.routed(files, profiles)
        union = lambda frames: reduce(DataFrame.unionByName, frames)
        blocks = union([self.parse(raw, own) for own, raw in parts])
        raw = union([raw.withColumn("engine_used", F.lit(own.name)) for own, raw in parts])
        # Written once: what follows reads blocks and pages many times over.
        shared = SharedFolder(self.spark)
        raw, blocks = shared.save(raw.drop("markdown"), "raw"), shared.save(blocks, "parsed")
        if words is not None:
            blocks = shared.save(page_text.repair_blocks(blocks, words), "repaired")
        if self.config.table_refine and candidates is not None:
            by = ["doc_id", "page_no", "block_id"]
            refined = tables.refine(blocks.where("block_type = 'table'"), candidates, by, self.config.max_tables_per_page)
            report = tables.refine_report(refined, self.config.table_refine_engine)
            blocks = blocks.where("block_type != 'table'").unionByName(refined.select(blocks.columns))
        else:
            report = None
        blocks = shared.save(quality.score_blocks(blocks, self.config.review), "scored")
        sizes = parsing.page_sizes(raw)
        sizes = shared.save(sizes, "sizes")
        pages = shared.save(quality.score_pages(sizes, blocks, self.config.review), "pages")
        engines = raw.groupBy("doc_id").agg(F.first("engine_used").alias("engine_used"))  # one for each document
        docs = quality.score_documents(pages).withColumn("source_file", F.col("doc_id").cast("string")).join(engines, "doc_id")
        out = {"pages": pages, "blocks": blocks, "documents": docs}
        if profiles is not None:
            out["profiles"] = profiles
        if report is not None:
            out["refine_report"] = report
        if self.config.save_overlay:
            out["overlays"] = render.overlay(blocks)
        if self.config.save_markdown:
            out["markdown"] = render.render_markdown(docs, pages, blocks)
        if self.config.save_html:
            out["html"] = render.render_html(docs, pages, blocks)
        out["page_comparison"], out["mismatches"] = compare.compare_documents(pages.select("doc_id", "page_no"), blocks, sources, profiles)
        out["page_comparison"], out["mismatches"] = shared.save(out["page_comparison"], "comparison"), shared.save(out["mismatches"], "mismatches")
        out["document_comparison"] = compare.summarize(out["page_comparison"])
        if self.config.save_comparison:
            heads = docs.select("doc_id", "source_file").join(out["document_comparison"], "doc_id")
            shown = out["page_comparison"].join(sizes.select("doc_id", "page_no", "source_image"), ["doc_id", "page_no"], "left")
            out["comparison_html"] = render.render_comparison(heads, shown, out["mismatches"], blocks)
        return out


def write(result: dict[str, DataFrame], path: str, fmt: str = "json") -> None:
    """One folder a table. Parquet to go on with, JSON to look at."""
    for name, df in result.items():
        df.write.mode("overwrite").format(fmt).save(f"{path}/{name}")


def write_results(result: dict[str, DataFrame], path: str) -> None:
    """A document's result whole, as readers.results() reads it: indented JSON, a file each, beside its markdown and HTML as text."""
    pages = result["pages"]
    nested = writers.nest(result["documents"], pages, result["blocks"])
    writers.save_pretty(nested, f"{path}/result")
    for name, column in (("markdown", "markdown"), ("html", "html"), ("comparison_html", "html")):
        if name in result:
            writers.save_text(result[name], column, f"{path}/{name}")


def build_table_set(blocks: DataFrame, ratio: float = 0.1, most: int | None = None) -> DataFrame:
    """Training set of tables: samples, without those that begin alike, split. most keeps that many samples in all, the first by source, page and block."""
    order = ["source", "page", "block_id"]
    samples = datasets.distinct_samples(datasets.table_samples(blocks), order)
    if most is not None:
        samples = samples.orderBy(*order).limit(most)
    return datasets.split_samples(samples, F.concat_ws("|", *order), ratio)


def build_structure_set(blocks: DataFrame, ratio: float = 0.1) -> DataFrame:
    """Training set of table structures: (filename, value: one JSON text, image, split), files numbered by source, page and block."""
    order = ["source", "page_no", "block_id"]
    rows = datasets.pubtab(blocks.where("block_type = 'table'"))
    rows = datasets.split_samples(datasets.file_names(rows, order), F.concat_ws("|", *order), ratio)
    return rows.select("filename", datasets.structure_json().alias("value"), "image", "split")


def evaluate_tables(pairs: DataFrame, most: int | None = None, only: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(one row a sample, one row in all); of pairs with a column sample_idx, the first `most` or the one numbered `only`, if asked for."""
    if only is not None:
        pairs = pairs.where(F.col("sample_idx") == only)
    elif most is not None:
        pairs = pairs.orderBy("sample_idx").limit(most)
    each = tables.compare_tables(pairs)
    return each, tables.evaluation_summary(each)


