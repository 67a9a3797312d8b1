"""Data gates: one row each, with the numbers and whether they pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions.jsontext import has_key
from callsift.functions.text import score_length


def schema_gate(lines: DataFrame, key: str = "text") -> DataFrame:
    """JSON lines (column `value`): rows, rows without the key, and whether none lacks it. A null value has the key."""
    counts = lines.agg(F.count("*").alias("total"), F.count_if(~has_key(F.col("value"), key)).alias("missing"))
    return counts.withColumn("passed", (F.col("total") > 0) & (F.col("missing") == 0))


def row_relation_gate(noisy: DataFrame, gold: DataFrame) -> DataFrame:
    """Rows on both sides: noisy >= gold > 0. Each side shrinks to one count before they meet."""
    sides = noisy.agg(F.count("*").alias("n"), F.lit("noisy").alias("side")).unionByName(
        gold.agg(F.count("*").alias("n"), F.lit("gold").alias("side"))
    )
    counts = sides.agg(
        F.max(F.when(F.col("side") == "noisy", F.col("n"))).alias("noisy_rows"),
        F.max(F.when(F.col("side") == "gold", F.col("n"))).alias("gold_rows"),
    )
    return counts.withColumn("passed", (F.col("gold_rows") > 0) & (F.col("noisy_rows") >= F.col("gold_rows")))


def short_ratio_gate(
    df: DataFrame, text: str = "text", least: int = V.SHORT_LENGTH, share: float = V.SHORT_SHARE
) -> DataFrame:
    """Rows shorter than `least` stripped characters may be at most `share` of all."""
    counts = df.agg(
        F.count("*").alias("total"), F.count_if(score_length(F.col(text)) < least).alias("short")
    )
    return counts.withColumn("passed", F.col("short") <= F.col("total") * F.lit(share))
