"""Model answers through a user-supplied batch function, attempts and the quality gate."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions.once import let, pin
from callsift.functions.text import is_blank
from callsift.operators.ledger import answered
from callsift.operators.skew import first_per_key

Ask = Callable[[Sequence], Sequence]


def drop_empty_input(df: DataFrame, text: str = "input") -> DataFrame:
    return df.where(F.coalesce(F.col(text), F.lit("")) != "")


def reject_blank_input(df: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows to score, blank rows with an error): blank texts never reach the model."""
    blank = is_blank(F.col(text))
    return df.where(~blank), df.where(blank).withColumn("error", F.lit(V.BLANK_INPUT_ERROR))


def _answers(ask: Ask, prompts: list) -> tuple[list, list]:
    """Answers and errors of one batch; a failing batch is asked again row by row, so one bad row fails alone."""
    try:
        got = list(ask(prompts))
        if len(got) != len(prompts):
            raise ValueError(f"{len(got)} answers for {len(prompts)} prompts")
        return got, [None] * len(got)
    except Exception as error:  # any failure of user code becomes a value in the error column
        if len(prompts) == 1:
            return [None], [f"{type(error).__name__}: {error}"]
    pairs = [_answers(ask, [prompt]) for prompt in prompts]
    return [a[0] for a, _ in pairs], [e[0] for _, e in pairs]


def score_with(
    df: DataFrame,
    make_ask: Callable[[], Ask],
    prompt: str = "prompt",
    answer: str = "answer",
    error: str = "error",
    batch_rows: int = 8,
    tasks: int | None = None,
    ledger: str | None = None,
    model: str = "",
) -> DataFrame:
    """Add the answer of `make_ask()(prompts)` and an error column.

    With a `ledger`, a folder that all runs share, answers are kept by `model` (the name of what answers) and prompt: equal
    prompts are asked once, answers of earlier and of failed runs are taken from there, and the result can be read again.
    Without one:

    `make_ask` runs once per partition, so that is where a client is made. Data goes through Arrow batches and other
    columns pass untouched. `tasks` bounds how many clients work at once. Use the result once or settle it: reading
    it again asks again.
    """
    if ledger:
        return answered(df, make_ask, _answers, ledger, model, uuid.uuid4().hex, prompt, answer, error, batch_rows)
    at = df.columns.index(prompt)
    schema = T.StructType(
        [*df.schema.fields, T.StructField(answer, T.StringType()), T.StructField(error, T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = make_ask()
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                part = batch.slice(start, batch_rows)
                answers, errors = _answers(ask, part.column(at).to_pylist())
                columns = [*part.columns, pa.array(answers, pa.string()), pa.array(errors, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, answer, error])

    spread = df.repartition(tasks) if tasks else df
    return spread.mapInArrow(run, schema)


def zip_predictions(rows: DataFrame, predictions: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Rows with their prediction, paired by an explicit row id that is unique on both sides."""
    return rows.join(predictions.select(row_id, "prediction"), row_id)


def align_runs(base: DataFrame, tuned: DataFrame, row_id: str = "row_id") -> DataFrame:
    """(row id, gold, base_pred, tuned_pred): both runs against the gold of the base run."""
    left = base.select(row_id, "gold", F.col("pred").alias("base_pred"))
    return left.join(tuned.select(row_id, F.col("pred").alias("tuned_pred")), row_id)


def quality_gate(df: DataFrame, least: int = 4, score: str = "score") -> DataFrame:
    """Samples whose judge score reaches the gate: 4 for guarded generation, 3 for plain."""
    return df.where(F.col(score) >= least)


def first_accepted_attempt(df: DataFrame, row_id: str = "id", least: int = 4, attempts: int = 3) -> DataFrame:
    """The first attempt (counted from 0) of each sample that reaches the gate; samples without one are left out."""
    tried = quality_gate(df, least).where(F.col("attempt") < attempts)
    return first_per_key(tried, [row_id], [F.col("attempt")])


def apply_modifiers(df: DataFrame, column: str, *stages: Callable[[Column], Column]) -> DataFrame:
    """Run text stages (Column to Column) one after the other over a column; each stage runs once per row."""
    changed = F.col(column)
    for stage in stages:
        changed = let(changed, stage)
    return pin(df, column, changed)


def apply_filter(
    df: DataFrame, column: str, score: Callable[[Column], Column], keep: Callable[[Column], Column],
    score_column: str | None = None,
) -> DataFrame:
    """Keep rows whose score passes; the score stays as a column when it is given a name."""
    if score_column:
        return df.withColumn(score_column, score(F.col(column))).where(keep(F.col(score_column)))
    return df.where(keep(score(F.col(column))))
