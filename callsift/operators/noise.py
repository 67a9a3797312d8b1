"""Noise injection: one draw per call decides what happens to it."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions import draws
from callsift.functions.once import choose
from callsift.functions.text import (
    break_umlauts, dup_marker_test, garbage_test, mojibake_test, pii_keyword_test,
)


def noise_branch(draw: Column, shares: dict[str, float] | None = None) -> Column:
    """Name of the branch for a draw in [0, 1); the shares are cumulated in their order, the rest is clean."""
    shares = shares or V.NOISE_SHARES
    branch, limits = F.lit("clean"), list(zip(shares, accumulate(shares.values())))
    for name, limit in reversed(limits):
        branch = F.when(draw < F.lit(limit), name).otherwise(branch)
    return branch


def _row(call_id: Column, text: Column, clean: bool, noise: str) -> Column:
    return F.struct(
        call_id.alias("call_id"), text.alias("text"), F.lit(clean).alias("is_clean"), F.lit(noise).alias("noise_type")
    )


def drop_empty_text(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(F.length(text) > 0)


def emit_duplicate(call_id: Column, text: Column) -> Column:
    """The call itself and a marked copy, as an array of two rows."""
    copy_id = F.concat(call_id, F.lit(V.DUPLICATE_MARK))
    return F.array(_row(call_id, text, True, "none"), _row(copy_id, text, False, "exact_duplicate"))


def with_branch(
    df: DataFrame, seed: int = V.SPLIT_SEED, shares: dict[str, float] | None = None, call_id: str = "call_id"
) -> DataFrame:
    draw = draws.digest(seed, F.col(call_id))
    return df.withColumn("_draw", draw).withColumn("branch", noise_branch(draws.uniform(F.col("_draw")), shares))


def inject_noise(df: DataFrame, seed: int = V.SPLIT_SEED, shares: dict[str, float] | None = None) -> DataFrame:
    """(call_id, text) to noisy calls (call_id, text, is_clean, noise_type); narrow, rows stay where they are."""
    call, text, branch = F.col("call_id").cast("string"), F.col("text"), F.col("branch")

    def chosen(values: list[str]) -> Column:
        return choose(values, draws.pick(F.col("_draw"), 1, len(values)))

    with_pii = F.concat(text, F.lit("\nAnrufer: "), chosen(V.PII_SAMPLES))
    rows = (
        F.when(branch == "duplicate", emit_duplicate(call, text))
        .when(branch == "pii", F.array(_row(call, with_pii, False, "pii_injection")))
        .when(branch == "garbage", F.array(_row(call, chosen(V.GARBAGE_SNIPPETS), False, "garbage_text")))
        .when(branch == "encoding", F.array(_row(call, break_umlauts(text), False, "encoding_error")))
        .otherwise(F.array(_row(call, text, True, "none")))
    )
    calls = with_branch(drop_empty_text(df.select("call_id", "text")), seed, shares)
    return calls.select(F.inline(rows))


def noise_stats(df: DataFrame, seed: int = V.SPLIT_SEED, shares: dict[str, float] | None = None) -> DataFrame:
    """Calls per branch, one per input call."""
    calls = with_branch(drop_empty_text(df.select("call_id", "text")), seed, shares)
    return calls.groupBy("branch").agg(F.count("*").alias("calls"))


def noise_presence(df: DataFrame) -> DataFrame:
    """One row: is any duplicate mark, personal data, garbage and mojibake there?"""

    def present(test: Column, name: str) -> Column:
        return F.coalesce(F.bool_or(test), F.lit(False)).alias(name)

    text = F.col("text")
    return df.agg(
        present(dup_marker_test(F.col("call_id")), "has_duplicates"),
        present(pii_keyword_test(text), "has_pii"),
        present(garbage_test(text), "has_garbage"),
        present(mojibake_test(text), "has_encoding_errors"),
    )
