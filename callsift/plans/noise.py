"""Noise job: raw calls, flat or nested, to noisy calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions.text import flatten_transcript
from callsift.operators.ids import position_fallback_id
from callsift.operators.noise import inject_noise, noise_stats
from callsift.session import settle, whole_job
from callsift.sources.jsonl import RAW_CALL, read_jsonl_lenient, write_jsonl
from callsift.sources.publish import publish


def flat_calls(raw: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """(call_id, text) from raw calls with call_id, id, text and response."""
    named = position_fallback_id(raw, order_by=order_by)
    return named.select("call_id", flatten_transcript(F.col("text"), F.col("response")).alias("text"))


@whole_job
def run_noise(spark: SparkSession, source: str, target: str, seed: int = V.SPLIT_SEED) -> dict[str, int]:
    """Write the noisy data set; returns calls per branch."""
    raw, _ = read_jsonl_lenient(spark, source, RAW_CALL, with_order=True)
    calls = settle(flat_calls(raw), "calls")
    stats = {r["branch"]: r["calls"] for r in noise_stats(calls, seed).collect()}
    if not stats:
        raise ValueError(f"{source}: no calls")
    publish(spark, target, lambda beside: write_jsonl(inject_noise(calls, seed), beside))
    return {branch: stats.get(branch, 0) for branch in [*V.NOISE_SHARES, "clean"]}
