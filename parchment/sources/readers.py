"""Readers of the engine's inputs and of its own saved results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed schema of a saved result; what is not listed is not read.
BLOCK = "struct<block_id:string,block_type:string,page_no:int,bbox:array<double>,text:string,html:string,markdown:string,confidence:double,review:boolean,review_reason:array<string>,source_engine:string,extra:map<string,string>>"
PAGE = f"struct<page_no:int,width:int,height:int,source_image:string,page_confidence:double,needs_review:boolean,review_reason:array<string>,blocks:array<{BLOCK}>,raw_paths:map<string,string>>"
RESULT = f"document_id string, source_file string, pdf_type string, page_count int, overall_confidence double, review_required_pages array<int>, engine_used string, pages array<{PAGE}>"


def files(spark: SparkSession, paths: str | list[str], pattern: str = "*", content: bool = True) -> DataFrame:
    """Files as rows; without content only their paths, sizes and times are read."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(paths)
    return rows if content else rows.drop("content")


def folders(root: str, prefix: str = "") -> str:
    """A pattern for the folders under root whose names begin with the prefix, for any reader's paths."""
    return f"{root.rstrip('/')}/{prefix}*"


def crops(spark: SparkSession, path: str) -> DataFrame:
    """(path, crop, crop_ord): images of tables in a folder, numbered in the order of their names."""
    rows = files(spark, path, "*.png", content=False).select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("crop"), F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"))
    return rows.withColumn("crop_ord", F.row_number().over(Window.partitionBy("folder").orderBy("crop"))).drop("folder")


def whole_texts(spark: SparkSession, paths: str | list[str], pattern: str) -> DataFrame:
    """(path, value): each file's text whole."""
    rows = spark.read.option("wholetext", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(paths)
    return rows.select(F.col("_metadata.file_path").alias("path"), "value")


def results(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Saved results of documents, as they were nested."""
    return spark.read.schema(RESULT).option("multiLine", True).json(paths)


def result_blocks(docs: DataFrame) -> DataFrame:
    """One row a block of saved results, with its place."""
    pages = docs.select("document_id", "source_file", F.explode("pages").alias("p"))
    rows = pages.select("document_id", "source_file", F.col("p.page_no").alias("page"), F.col("p.source_image").alias("image"), F.posexplode("p.blocks").alias("i", "b"))
    return rows.select("document_id", F.col("source_file").alias("source"), "page", "image", (F.col("i") + 1).alias("block_ord"), "b.*")


def json_lines(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Rows of JSON lines; blank lines are none."""
    lines = spark.read.text(paths).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def count_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.text(paths).where(F.trim("value") != "").agg(F.count("*").alias("lines"))
