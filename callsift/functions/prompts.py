"""Prompt texts and chat messages as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions import draws
from callsift.functions.once import choose


def prompt_instruction(text: Column) -> Column:
    return F.concat(F.lit(V.INSTRUCTION_HEAD), text, F.lit("\n\n" + V.RESPONSE_HEAD))


def format_training_text(columns: list[str], eos: str) -> Column:
    """Training text for a table with these columns: instruction and response, else `text`, else the first column."""
    if "input" in columns and "output" in columns:
        body = F.concat(prompt_instruction(F.col("input")), F.col("output"))
    else:
        body = F.col("text" if "text" in columns else columns[0]).cast("string")
    return F.concat(body, F.lit(eos))


def prompt_question(text: Column) -> Column:
    return F.concat(F.lit(V.QUESTION_HEAD), text, F.lit(V.QUESTION_TAIL))


def prompt_concat(text: Column, output: Column) -> Column:
    return F.concat(text, output)


def prompt_inference(text: Column) -> Column:
    return F.concat(F.lit(V.INFERENCE_HEAD), text)


def prompt_quality(text: Column) -> Column:
    return F.concat(F.lit(V.QUALITY_HEAD), text, F.lit(V.QUALITY_TAIL))


def message(role: str, content: Column | str) -> Column:
    content = F.lit(content) if isinstance(content, str) else content
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def _shown(examples: list[tuple[str, str]]) -> list[Column]:
    return [m for asked, said in examples for m in (message("user", asked), message("assistant", said))]


def messages_baseline(text: Column) -> Column:
    return F.array(message("system", V.BASELINE_SYSTEM), message("user", text))


def messages_eval(text: Column, mode: str = "few-shot", style: str = "reasoned") -> Column:
    """Evaluation messages: `zero-shot` or `few-shot`; style `reasoned` asks for a Result line, `word` for one word."""
    if mode not in ("zero-shot", "few-shot"):
        raise ValueError(f"unknown mode {mode!r}")
    system, examples = V.EVAL_STYLES[style]
    shown = _shown(examples) if mode == "few-shot" else []
    return F.array(message("system", system), *shown, message("user", text))


def messages_worker(text: Column) -> Column:
    return F.array(message("system", V.WORKER_SYSTEM), *_shown(V.WORKER_EXAMPLES), message("user", text))


def messages_judge(text: Column, gold: Column, answer: Column) -> Column:
    question = F.concat(
        F.lit(V.JUDGE_CALL), text,
        F.lit("\n" + V.JUDGE_GOLD), gold,
        F.lit("\n" + V.JUDGE_ANSWER + "\n"), answer,
    )
    return F.array(message("system", V.JUDGE_SYSTEM), message("user", question))


def messages_generate(prompt: Column, source: str) -> Column:
    return F.array(message("system", V.GENERATOR_SYSTEM % source), message("user", prompt))


def messages_quality(text: Column) -> Column:
    return F.array(message("user", prompt_quality(text)))


def label_by_parity(number: Column) -> Column:
    return F.when(number % 2 != 0, "fraud").otherwise("legitimate")


def prompt_plan(number: Column, seed: int = V.SPLIT_SEED) -> dict[str, Column]:
    """Columns of the generation plan for a running number; every choice is a slice of one digest."""
    draw = draws.digest(seed, number)
    name = choose(V.CUSTOMER_NAMES, draws.pick(draw, 0, len(V.CUSTOMER_NAMES)))
    tone = choose(V.TONES, draws.pick(draw, 1, len(V.TONES)))
    size = draws.pick(draw, 2, len(V.LENGTHS))
    length = choose([text for text, _ in V.LENGTHS], size)
    scene = draws.pick(draw, 3, len(V.FRAUD_SCENARIOS))

    def filled(template: str, scenarios: list[str]) -> Column:
        return F.format_string(template, name, choose(scenarios, scene), tone, length)

    label = label_by_parity(number)
    return {
        "id": F.format_string("doc-%05d", number.cast("bigint")),
        "label": label,
        "max_tokens": choose([cap for _, cap in V.LENGTHS], size),
        "prompt": F.when(label == "fraud", filled(V.FRAUD_PLAN, V.FRAUD_SCENARIOS)).otherwise(
            filled(V.LEGITIMATE_PLAN, V.LEGITIMATE_SCENARIOS)
        ),
    }
