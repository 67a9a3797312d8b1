"""Arriving files: stateless curation, and a running count per label."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from callsift.plans.curate import clean_rows
from callsift.sources.publish import Folder


def label_counts(answers: DataFrame, label: str = "label") -> DataFrame:
    """Running count per label. State is one row per label, however long the stream is."""
    return answers.groupBy(label).agg(F.count("*").alias("calls"))


AVAILABLE_NOW = {"availableNow": True}


#: Batches whose changes are kept one by one before they are folded into a snapshot.
COMPACT_EVERY = 10


class CountTable:
    """Counts as a snapshot and the changes since: `upto=N` holds all labels after batch N, `batch=N` what batch N changed.

    Folders have a name of their own per batch and are written as a whole, so a repeated batch changes nothing. The snapshot
    before the newest stays with the changes behind it, so that a reader that is under way finds its files.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, Folder(spark, path)

    def found(self, kind: str) -> dict[int, str]:
        """number -> path of the complete folders of a kind."""
        files, root = self.folder.files, self.folder.path
        names = [s.getPath() for s in files.listStatus(root)] if files.exists(root) else []
        some = [p for p in names if p.getName().startswith(f"{kind}=") and files.exists(self.folder.new_path(p, "_SUCCESS"))]
        return {int(p.getName().partition("=")[2]): p.toString() for p in some}

    def counts(self, upto: int | None = None) -> DataFrame:
        """The newest count of every label; with `upto`, as after that batch."""
        last = upto if upto is not None else 1 << 62
        start = max((n for n in self.found("upto") if n <= last), default=-1)
        parts = {n: p for n, p in self.found("batch").items() if start < n <= last}
        if start >= 0:
            parts[start] = self.found("upto")[start]
        if not parts:
            raise FileNotFoundError(f"no complete batch under {self.folder.path}")
        rows = [self.spark.read.parquet(p).withColumn("_batch", F.lit(n)) for n, p in sorted(parts.items())]
        whole = reduce(DataFrame.unionByName, rows)
        names = [c for c in whole.columns if c not in ("calls", "_batch")]
        return whole.groupBy(*names).agg(F.max_by("calls", "_batch").alias("calls"))

    def publish(self, changes: DataFrame, number: int, compact_every: int = COMPACT_EVERY) -> None:
        changes.coalesce(1).write.mode("overwrite").parquet(f"{self.folder.path.toString()}/batch={number:012d}")
        if (number + 1) % compact_every == 0:
            self.counts(upto=number).write.mode("overwrite").parquet(f"{self.folder.path.toString()}/upto={number:012d}")
            kept = sorted(self.found("upto"))[-2:]
            old = [p for kind in ("upto", "batch") for n, p in self.found(kind).items() if n < kept[0] or kind == "batch" and n == kept[0]]
            for path in old if len(kept) > 1 else []:
                self.folder.files.delete(self.folder.new_path(path), True)


def stream_fraud_counter(
    answers: DataFrame, table: str, checkpoint: str, label: str = "label", trigger: dict | None = None, compact_every: int = COMPACT_EVERY
) -> StreamingQuery:
    """Keep the running counts under `table`; by default handles what has arrived and stops.

    State is kept by label, and a batch writes the labels that it changed. After every `compact_every` batches they are
    folded into a snapshot and older folders go, so that at most three times as many are there. current_counts() reads.
    """

    def publish(batch: DataFrame, number: int) -> None:
        CountTable(batch.sparkSession, table).publish(batch, number, compact_every)

    return (
        label_counts(answers, label)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .foreachBatch(publish)
        .start()
    )


def current_counts(spark: SparkSession, table: str) -> DataFrame:
    """The counts after the newest complete batch."""
    return CountTable(spark, table).counts()


def stream_curate_rows(
    docs: DataFrame, target: str, checkpoint: str, text: str = "text", trigger: dict | None = None
) -> StreamingQuery:
    """Repair, mask and length-filter arriving documents into a parquet data set; no state."""
    return (
        clean_rows(docs, text)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def arriving(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stream over the parquet files that arrive in a folder, or in what a pattern such as `in/{events}.parquet` matches."""
    return spark.readStream.schema(schema).parquet(path)
