"""Exact duplicates by md5 of the text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.functions.text import long_enough, score_length
from callsift import fixed_values as V
from callsift.operators.skew import first_per_key, lookup_join
from callsift.session import settle


def with_hash(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("_hashes", F.md5(text))


def _settled_hashes(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """(id, _hashes), written once: the passes that follow read two short columns and no text."""
    return settle(with_hash(df.select(row_id, text), text).select(row_id, "_hashes"), "hashes")


def duplicate_groups(df: DataFrame, row_id: str = "id", text: str = "text") -> DataFrame:
    """(id, _hashes) of every row whose text occurs more than once.

    Groups are counted with map-side combine, and only ids and hashes are joined back. A hot text is not shuffled.
    """
    slim = _settled_hashes(df, row_id, text)
    shared = slim.groupBy("_hashes").agg(F.count("*").alias("_copies")).where("_copies > 1").select("_hashes")
    return lookup_join(slim, shared, "_hashes").select(row_id, "_hashes")


def keep_first_duplicate(df: DataFrame, row_id: str = "id", text: str = "text") -> DataFrame:
    """Keep the row with the smallest id of each text: one shuffle, cut to one row per text and task before it."""
    return first_per_key(with_hash(df, text), ["_hashes"], [F.col(row_id)]).drop("_hashes")


def later_duplicates(df: DataFrame, row_id: str = "id", text: str = "text") -> DataFrame:
    """Ids that keep_first_duplicate drops."""
    slim = _settled_hashes(df, row_id, text)
    first = slim.groupBy("_hashes").agg(F.min(row_id).alias("_first"))
    return lookup_join(slim, first, "_hashes").where(F.col(row_id) > F.col("_first")).select(row_id)


def drop_duplicates_by_id(df: DataFrame, to_remove: DataFrame, row_id: str = "id") -> DataFrame:
    """Rows whose id is not on the list. Ids are unique, so the join has no hot key."""
    return df.join(to_remove.select(row_id), row_id, "left_anti")


def curation_stats(df: DataFrame, text: str = "text", least: int = V.MIN_LENGTH) -> DataFrame:
    """One row: rows in, too short, later duplicates, kept, removed, removed share in percent.

    Only hashes are shuffled, once, after map-side counting; short texts share one key and collapse there too.
    """
    long = long_enough(score_length(F.col(text)), least)
    groups = df.select(F.when(long, F.md5(text)).alias("_hashes")).groupBy("_hashes").agg(F.count("*").alias("n"))
    short = F.coalesce(F.sum(F.when(F.col("_hashes").isNull(), F.col("n"))), F.lit(0))
    total = F.coalesce(F.sum("n"), F.lit(0))
    kept = F.count("_hashes")
    counts = groups.agg(total.alias("rows_in"), short.alias("too_short"), kept.alias("kept"))
    removed = F.col("rows_in") - F.col("kept")
    return counts.select(
        "rows_in",
        "too_short",
        (removed - F.col("too_short")).alias("duplicates"),
        "kept",
        removed.alias("removed"),
        F.coalesce(F.try_divide(removed * 100.0, F.col("rows_in")), F.lit(0.0)).alias("removed_percent"),
    )
