"""Joins and per-key picks that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_SHARE = 0.01  # a key with less of the rows is left to the ordinary join
HOT_ROWS = 100_000  # nor is a key with fewer rows worth a plan of its own


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE, rows: int = HOT_ROWS) -> list:
    """The keys that hold at least `share` of the rows and at least `rows` of them; at most 1/share values.

    A sketch names every such key and some others; a second pass over the key column counts the named ones.
    """
    keys = df.select(key).where(F.col(key).isNotNull())
    named = list(keys.freqItems([key], support=share).first()[0] or [])
    if not named:
        return []
    counts = keys.groupBy(F.when(F.col(key).isin(named), F.col(key)).alias("k")).agg(F.count("*").alias("n")).collect()
    least = max(rows, share * sum(c["n"] for c in counts))
    return [c["k"] for c in counts if c["k"] is not None and c["n"] >= least]


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    share: float | None = HOT_SHARE,
    rows: int = HOT_ROWS,
) -> DataFrame:
    """Join `left` to a `right` that has one row per key, without sending a hot key's rows to one task.

    Keys that are hot on the left meet their right rows (at most 1/share of them, so the broadcast is bounded) where
    they are; the rest is an ordinary join that Catalyst and AQE plan by size. `how` is inner or left.
    `share=None` leaves skew to AQE and saves the pass over the keys.
    """
    if how not in ("inner", "left"):
        raise ValueError("lookup_join is for inner and left joins")
    hot = hot_keys(left, key, share, rows) if share else []
    known, is_hot = F.col(key).isNotNull(), F.col(key).isin(hot)
    lone = how == "left" and left.schema[key].nullable  # null keys find nothing, so they need not travel
    rest = left.where(known & ~is_hot) if hot else left.where(known) if lone else left
    joined = rest.join(right.where(~is_hot) if hot else right, key, how)
    if hot:
        joined = joined.unionByName(left.where(is_hot).join(F.broadcast(right.where(is_hot)), key, how))
    if lone:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name != key]
        joined = joined.unionByName(left.where(~known).select("*", *nothing))
    return joined


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of every key in the given order.

    The filter on row_number lets Spark cut each task's input to one row per key before the shuffle
    (WindowGroupLimit), so a group of copies sends at most one row per task however large it is.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")
