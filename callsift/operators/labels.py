"""Gold labels: one per id, joined to documents, counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions.text import document_key, gold_label
from callsift.operators.skew import lookup_join


def present_columns(df: DataFrame, names: list[str]) -> list[Column]:
    """The named columns as strings; those that the table lacks are null."""
    return [F.col(n).cast("string") if n in df.columns else F.lit(None).cast("string") for n in names]


def gold_last_wins(
    gold: DataFrame, order_by: list[str], row_id: str = "id", aliases: tuple[str, ...] = ("label", "fraud_type", "ground_truth")
) -> DataFrame:
    """(id, label): the last label of each id in the given order; rows without id or label do not count."""
    label = gold_label(*present_columns(gold, list(aliases)))
    usable = gold.select(F.col(row_id).cast("string").alias("id"), label.alias("label"), F.struct(*order_by).alias("_at"))
    return (
        usable.where("id <> '' and label is not null")
        .groupBy("id")
        .agg(F.max_by("label", "_at").alias("label"))
    )


def with_key(docs: DataFrame, call_id: str = "call_id", row_id: str = "id") -> DataFrame:
    return docs.withColumn("_key", document_key(*present_columns(docs, [call_id, row_id])))


def attach_gold(docs: DataFrame, gold: DataFrame, how: str = "inner") -> DataFrame:
    """Documents with their gold label; `left` keeps the unmatched ones. `gold` has one row per id."""
    return lookup_join(with_key(docs), gold.withColumnRenamed("id", "_key"), "_key", how).drop("_key")


def match_stats(docs: DataFrame, gold: DataFrame) -> DataFrame:
    """One row: total, matched, unmatched. Keys are counted before the join, texts are not read."""
    keys = with_key(docs).groupBy("_key").agg(F.count("*").alias("n"))
    joined = keys.join(gold.withColumnRenamed("id", "_key"), "_key", "left")
    total = F.coalesce(F.sum("n"), F.lit(0))
    matched = F.coalesce(F.sum(F.when(F.col("label").isNotNull(), F.col("n"))), F.lit(0))
    return joined.agg(total.alias("total"), matched.alias("matched"), (total - matched).alias("unmatched"))


def to_sft_pair(df: DataFrame) -> DataFrame:
    """Texts and labels as input and output; a missing text is ''."""
    return df.select(F.coalesce("text", F.lit("")).alias("input"), F.col("label").alias("output"))


def map_columns(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    return df.withColumnsRenamed(names or {"input": "question", "output": "answer"})


def label_distribution(gold: DataFrame, aliases: tuple[str, ...] = ("label", "fraud_type", "ground_truth")) -> DataFrame:
    """One row: label counts, fraud share and whether the share passes the gate. The first alias with a value counts."""
    label = gold_label(*present_columns(gold, list(aliases)))
    fraud, legit = (F.count_if(label == name) for name in V.LABELS)
    share = F.coalesce(F.try_divide(fraud.cast("double"), F.count("*")), F.lit(0.0))
    low, high = V.FRAUD_SHARE
    return gold.agg(
        F.count("*").alias("total"), legit.alias("legitimate"), fraud.alias("fraud"), share.alias("fraud_share")
    ).withColumn(
        "passed", (F.col("legitimate") > 0) & (F.col("fraud") > 0) & F.col("fraud_share").between(low, high)
    )
