"""Sinks for samples, predictions, reports and run metrics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.functions.text import one_line, strip
from callsift.session import settle
from callsift.sources.jsonl import write_jsonl
from callsift.sources.paired import PairedSink, content_id
from callsift.sources.publish import publish

#: Names a batch by its samples.
CONTENT = "content"


def append_pair_sink(accepted: DataFrame, transcripts: str, gold: str, source: str, batch: str | None = None) -> bool:
    """Append each accepted sample (id, text, label, score) to a transcript and a gold data set, as one batch.

    The samples are settled first: answers are costly, and both outputs must come from the same ones. `batch` names them:
    a batch that is in both already is not appended again (False), and one that a crash left in one of them is completed,
    by whatever is appended next. CONTENT names samples by what they hold; without a name, every call is a batch of its own.
    """
    samples = settle(accepted.select("id", "text", "label", "score"), "accepted")
    sink = PairedSink(accepted.sparkSession, transcripts, gold)
    name = content_id(samples) if batch == CONTENT else batch or uuid.uuid4().hex
    return sink.append(samples.select("id", "text", F.lit(source).alias("source")), samples.select("id", "label", "score"), name)


def judge_report(df: DataFrame) -> DataFrame:
    return df.select(
        "id", "true_label", "model_prediction", "judge_score", one_line(F.col("model_output")).alias("model_output")
    )


def report_extract(df: DataFrame) -> DataFrame:
    return df.select("id", "true_label", "model_prediction", "judge_score")


def write_report_csv(df: DataFrame, path: str) -> None:
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    publish(df.sparkSession, path, judge_report(df).write.options(header=True, escape='"', **blanks).csv)


def write_predictions(df: DataFrame, path: str) -> None:
    """Input rows plus the stripped prediction."""
    shown = df.withColumn("prediction", strip(F.col("prediction")))
    publish(df.sparkSession, path, lambda beside: write_jsonl(shown, beside))


def long_metrics(metrics: DataFrame, run: str, params: dict[str, str]) -> DataFrame:
    """One metrics row to (run, params, metric, value) rows."""
    pairs = F.create_map(*[F.lit(x) for item in params.items() for x in item]).cast("map<string,string>")
    rows = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in metrics.columns]
    return metrics.select(F.lit(run).alias("run"), pairs.alias("params"), F.inline(F.array(*rows)))


def log_run_metrics(metrics: DataFrame, run: str, params: dict[str, str], path: str) -> None:
    """Write the metrics of one run into its own part of the table; running again under one id replaces that part."""
    rows = long_metrics(metrics, run, params)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)


def eval_table(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("input").alias("input_text"), F.col("gold").alias("expected_label"), F.col("pred").alias("predicted_label")
    )


def write_eval_table(df: DataFrame, path: str) -> None:
    publish(df.sparkSession, path, eval_table(df).write.parquet)
