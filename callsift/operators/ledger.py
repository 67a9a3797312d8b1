"""Model answers that are asked for once: a table of answers by digest of model and prompt, appended task by task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.operators.skew import lookup_join
from callsift.session import settle

LEDGER = "digest STRING, answer STRING, error STRING, run STRING"

_clients: dict[str, Callable] = {}


def prompt_digest(model: str, prompt: Column) -> Column:
    """What an answer is known by: the model's name and the whole prompt."""
    return F.sha2(F.to_json(F.struct(F.lit(model).alias("model"), prompt.alias("prompt")), {"ignoreNullFields": "false"}), 256)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a ledger; none if there is no ledger yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], LEDGER)


def known_answers(ledger: DataFrame) -> DataFrame:
    """(digest, answer): one answer of each digest that has one; of several the smallest, so that every reader takes the same."""
    return ledger.where("answer IS NOT NULL").groupBy("digest").agg(F.min("answer").alias("answer"))


def ask_missing(prompts: DataFrame, make_ask: Callable, answers_of: Callable, path: str, run: str, batch_rows: int, batches_per_task: int) -> None:
    """Ask for the (digest, prompt) rows that the ledger has no answer to, and append the answers.

    A task asks for `batches_per_task` batches and commits them as one file when it ends, not when the job ends. So what
    finished tasks were told stays, whatever becomes of the job, and a lost task asks again for its own rows at most. A
    client is made once for each Python worker and job.
    """
    missing = settle(prompts.join(known_answers(read_ledger(prompts.sparkSession, path)).select("digest"), "digest", "left_anti"), "missing")
    rows = missing.count()
    if not rows:
        return

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                if run not in _clients:
                    _clients.clear()
                    _clients[run] = make_ask()
                part = batch.slice(start, batch_rows)
                answers, errors = answers_of(_clients[run], part.column(1).to_pylist())
                columns = [part.column(0), pa.array(answers, pa.string()), pa.array(errors, pa.string()), pa.array([run] * part.num_rows, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["digest", "answer", "error", "run"])

    size = batch_rows * batches_per_task
    asked = missing.select("digest", "prompt").repartition(-(-rows // size)).mapInArrow(work, LEDGER)
    asked.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(path)


def answered(
    df: DataFrame,
    make_ask: Callable,
    answers_of: Callable,
    path: str,
    model: str,
    run: str,
    prompt: str = "prompt",
    answer: str = "answer",
    error: str = "error",
    batch_rows: int = 8,
    batches_per_task: int = 1,
) -> DataFrame:
    """The rows with an answer and an error column, both read from the ledger at `path`.

    Equal prompts are asked once. What earlier runs were told is not asked again, be they other jobs, runs that failed or
    tasks that were lost; errors are no answers, so a later run asks again for those. Reading the result asks nothing.
    """
    named = df.withColumn("_digest", prompt_digest(model, F.col(prompt)))
    prompts = named.groupBy(F.col("_digest").alias("digest")).agg(F.first(prompt).alias("prompt"))
    ask_missing(prompts, make_ask, answers_of, path, run, batch_rows, batches_per_task)
    told = read_ledger(df.sparkSession, path)
    errors = told.where((F.col("run") == run) & F.col("error").isNotNull()).groupBy("digest").agg(F.max("error").alias("error"))
    found = settle(known_answers(told).join(errors, "digest", "full"), "answers")
    found = found.select(F.col("digest").alias("_digest"), F.col("answer").alias(answer), F.when(F.col("answer").isNull(), F.col("error")).alias(error))
    return lookup_join(named, found, "_digest", "left").select(*df.columns, answer, error)
