"""Generation: plan, answers, cleaning, judge score, gate, up to three attempts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions import draws, prompts
from callsift.functions.answers import clean_answer, judge_score, unwrap_guarded
from callsift.functions.text import strip
from callsift.operators.scoring import quality_gate, score_with
from callsift.session import settle


def plan_samples(numbers: DataFrame, number: str = "number", seed: int = V.SPLIT_SEED) -> DataFrame:
    """(id, label, max_tokens, prompt) for a table of running numbers, such as spark.range(1, n + 1, 1)."""
    return numbers.select(*[c.alias(name) for name, c in prompts.prompt_plan(F.col(number), seed).items()])


def generate(
    plan: DataFrame,
    make_writer: Callable,
    make_judge: Callable,
    source: str,
    least: int = 4,
    attempts: int = 3,
    guarded: bool = True,
    seed: int = V.SPLIT_SEED,
    judge_name: str = "",
    **scoring,
) -> DataFrame:
    """(id, text, label, score, attempt) of the first accepted attempt of each sample.

    The writer gets {messages, temperature, max_tokens}, the judge gets messages. Each attempt asks only for samples
    that no earlier one settled, and its answers are written once. With a ledger, the writer's answers are kept under
    `model`, the judge's under `judge_name`.
    """
    pending, accepted = plan, []
    for attempt in range(attempts):
        draw = draws.digest(seed, F.col("id"), F.lit(attempt))
        request = F.struct(
            prompts.messages_generate(F.col("prompt"), source).alias("messages"),
            draws.temperature(draw).alias("temperature"),
            "max_tokens",
        )
        written = score_with(
            pending.withColumn("_ask", request), make_writer, "_ask", "_raw", "_error", **scoring
        ).drop("_ask", "_error")
        raw = unwrap_guarded(F.col("_raw")) if guarded else strip(F.col("_raw"))
        texts = settle(written.withColumn("text", clean_answer(raw, missing_is_raw=guarded)).drop("_raw"), "texts")
        asked = texts.where("text is not null").withColumn("_ask", prompts.messages_quality(F.col("text")))
        judged = score_with(asked, make_judge, "_ask", "_raw", "_error", **{**scoring, "model": judge_name})
        scored = settle(judged.withColumn("score", judge_score(F.col("_raw"))).drop("_ask", "_raw", "_error"), "scored")
        taken = quality_gate(scored, least).withColumn("attempt", F.lit(attempt))
        accepted.append(taken.select("id", "text", "label", "score", "attempt"))
        failed = texts.where("text is null").select(plan.columns)
        pending = scored.where(F.col("score") < least).select(plan.columns).unionByName(failed)
    result = accepted[0]
    for part in accepted[1:]:
        result = result.unionByName(part)
    return result
