"""Evaluation: prompts, answers, labels, metrics; and the two-step judge."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift.functions import prompts
from callsift.functions.answers import gold_plain, parse_judge, parse_result_tag
from callsift.functions.text import is_blank, strip
from callsift.operators.ids import report_row_number
from callsift.operators.metrics import run_metrics
from callsift.operators.scoring import drop_empty_input, reject_blank_input, score_with
from callsift.functions.answers import parse_with_confidence
from callsift.session import settle
from callsift.sources.reports import log_run_metrics


def predict(
    pairs: DataFrame,
    make_ask: Callable,
    modes: tuple[str, ...] = ("zero-shot", "few-shot"),
    style: str = "reasoned",
    gold: Callable[[Column], Column] = gold_plain,
    parse: Callable[[Column], Column] = parse_result_tag,
    **scoring,
) -> DataFrame:
    """Rows with mode, gold, pred, answer and error; every mode asks for every row with an input, in one job."""
    rows = drop_empty_input(pairs)
    asked = [F.struct(F.lit(m).alias("mode"), prompts.messages_eval(F.col("input"), m, style).alias("prompt")) for m in modes]
    scored = score_with(rows.select("*", F.inline(F.array(*asked))), make_ask, **scoring).drop("prompt")
    return scored.withColumn("gold", gold(F.col("output"))).withColumn("pred", parse(F.col("answer")))


def evaluate(
    pairs: DataFrame,
    make_ask: Callable,
    metrics_path: str | None = None,
    run: str | None = None,
    model_name: str = "",
    dataset_file: str = "",
    **options,
) -> DataFrame:
    """The run metrics, one row per mode. Answers are settled, so the model is asked once per row and mode.

    With a metrics path, each mode is logged as `run`-mode (default: a new id) with model, data set and mode.
    """
    run = run or uuid.uuid4().hex
    answers = settle(predict(pairs, make_ask, **options), "answers")
    metrics = run_metrics(answers, by=["mode"])
    if metrics_path:
        for mode in options.get("modes", ("zero-shot", "few-shot")):
            one = metrics.where(F.col("mode") == mode).drop("mode")
            params = {"model_name": model_name, "dataset_file": dataset_file, "evaluation_mode": mode}
            log_run_metrics(one, f"{run}-{mode}", params, metrics_path)
    return metrics


def judge(pairs: DataFrame, make_worker: Callable, make_judge: Callable, order_by: list[str], judge_name: str = "", **scoring) -> DataFrame:
    """The judge report: worker answer, label, and the verdict of a second model on them.

    Rows without a verdict stay, with null columns, as they count in the pass rate. Worker answers are settled before
    the judge reads them. `order_by` must identify a row and be short: it is what the report is numbered by. With a ledger,
    the worker's answers are kept under `model`, the judge's under `judge_name`.
    """
    rows = report_row_number(drop_empty_input(pairs), order_by)
    rows = rows.select("id", F.col("input").alias("_text"), gold_plain(F.col("output")).alias("true_label"))
    asked = rows.withColumn("prompt", prompts.messages_worker(F.col("_text")))
    worked = settle(score_with(asked, make_worker, answer="model_output", **scoring).drop("prompt"), "worker")
    output = strip(F.col("model_output"))
    shown = worked.withColumn("model_output", output).withColumn("model_prediction", parse_result_tag(output))
    done = shown.where("model_output is not null")
    asked = done.withColumn("prompt", prompts.messages_judge(F.col("_text"), F.col("true_label"), F.col("model_output")))
    judged = score_with(asked.drop("error"), make_judge, answer="_verdict", **{**scoring, "model": judge_name})
    report = judged.withColumn("judge_score", parse_judge(F.col("_verdict")))
    columns = ["id", "true_label", "model_prediction", "judge_score", "model_output", "error"]
    failed = shown.where("model_output is null").withColumn("judge_score", F.lit(None).cast("string"))
    return report.select(columns).unionByName(failed.select(columns))


def infer(df: DataFrame, make_ask: Callable, text: str = "text", **scoring) -> DataFrame:
    """Label, confidence and prompt length of each text; blank texts come back with an error and are not asked."""
    good, blank = reject_blank_input(df, text)
    asked = good.withColumn("prompt", prompts.prompt_inference(F.col(text)))
    scored = score_with(asked, make_ask, **scoring)
    found = parse_with_confidence(F.col("answer"))
    labelled = scored.select(
        *df.columns, found["label"].alias("label"), found["confidence"].alias("confidence"),
        F.length("prompt").alias("prompt_length"), "error",
    )
    return labelled.unionByName(blank, allowMissingColumns=True)
