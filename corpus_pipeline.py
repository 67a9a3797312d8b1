"""From raw documents to packed training sequences: each stage is a DataFrame -> DataFrame step, written and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.llm.base import table
from callsift.llm.language_id import UNKNOWN, predict, train
from callsift.llm.packing import pack
from callsift.llm.quality_rules import apply_quality_rules
from callsift.llm.repeats import remove_repeats
from callsift.llm.simhash import simhash_components
from callsift.session import settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_text(df: DataFrame, text: str) -> DataFrame:
    return df.withColumns({"text": F.col(text), "n_chars": F.length(text).cast("long")}).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines leave the texts; documents that the rules reject go."""
    return _with_text(apply_quality_rules(docs).where("kept"), "clean_text")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language or with an ambiguous one go; a missing lang is filled in.

    The classifiers learn from the documents' own labels; without any label nothing can be told, and all documents stay.
    """
    model = train(docs)
    if not model.languages:
        return docs.select(*COLUMNS)
    known = predict(docs, model).where((F.col("lang_pred") != UNKNOWN) & ~F.col("ambiguous"))
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, that with the smallest doc_id stays (null ids last; of repeated rows one)."""
    rows = settle(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    groups = simhash_components(rows, "_row").select("_row", "component_id")
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    named = groups.join(rows.select("_row", order.alias("_doc")), "_row")
    first = named.groupBy("component_id").agg(F.min(F.struct("_doc", "_row")).alias("first")).select(F.col("first._row").alias("_row"))
    return rows.join(settle(first, "survivors"), "_row", "left_semi").select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that start earlier leave the texts; documents with nothing left go."""
    return _with_text(remove_repeats(docs).where(F.trim("kept_text") != ""), "kept_text")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens, with their ids."""
    return pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("SimHash near-dedup", simhash),
    ("suffix-array dedup", suffix_dedup),
    ("packing", packing),
]

#: No SQL: shingle hashes, trained classifiers and token ids cannot be expressed in it; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over all documents; every stage but the last is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
