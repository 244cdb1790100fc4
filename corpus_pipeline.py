"""A training-corpus pipeline out of the operators of parchment.llm.

Each stage takes (spark, docs, sf_dir) and works on all documents that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parchment.llm.common import Shared, crc_mod, scratch
from parchment.llm.exact import exact_dedup
from parchment.llm.langid import keep_known
from parchment.llm.minhash import near_copies
from parchment.llm.mixing import repeat
from parchment.llm.packing import pack_documents


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay: those with letters, and a language that takes half of the score or more.

    Learned from documents with a language whose crc32 modulo 5 is not 0. Null texts and texts without letters go; repeated rows share
    their fate; without anything to learn from all go. An empty table gives an empty one; all columns stay as they are.
    """
    return keep_known(docs, docs.where(crc_mod("doc_id", 5) != 0))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of byte-equal texts stays: that with the largest doc_id.

    Null texts equal empty ones; of repeated rows one stays; null ids come before all others. An empty table gives an empty one; all columns
    stay as they are.
    """
    return exact_dedup(docs, keep="max")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays, that with the smallest doc_id; links join texts whose 5-word shingles have a Jaccard similarity of 0.8 or more.

    Texts without words, null ones among them, are alike; null ids come last, ties of ids go by a digest of the text; of repeated rows one
    stays. An empty table gives an empty one; all columns stay as they are.
    """
    return near_copies(docs, words=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: sources weigh 1, 2, 3, repeating, up to 3 copies.

    Documents without words, null ones among them, are not taken; null sources are one source. Repeated rows share the copies of all of them. An empty
    table gives an empty one; all columns stay as they are.
    """
    return repeat(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All copies' tokens in sequences of 2048: one row a piece (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    Null and empty texts are the end id alone; copies and repeated rows are packed each on its own. An empty table gives an empty result; other
    columns are not read.
    """
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048).withColumnRenamed("id", "doc_id")


STAGES = [("language", language), ("exact", exact), ("near", near), ("mix", mixed), ("pack", packed)]

#: Language identification, fingerprints and tokens are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; each result but the last is written to the shared folder and read again, and what a stage needed itself then goes."""
    shared = Shared(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), ""
    for name, stage in STAGES[:-1]:
        with scratch():
            docs = shared.save(stage(spark, docs, sf_dir), name)
        if before:
            shared.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
