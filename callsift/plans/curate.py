"""Curation: ids, encoding repair, masking, minimum length, exact duplicates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions.masking import mask_pii
from callsift.functions.once import pin
from callsift.functions.records import record_line, record_spans, record_text
from callsift.functions.text import long_enough, padded_id, repair_layers, repair_unicode, score_length
from callsift.operators.dedup import keep_first_duplicate
from callsift.operators.ids import number_by_position
from callsift.operators.scoring import apply_filter, apply_modifiers
from callsift.session import settle, whole_job
from callsift.sources.jsonl import check_lines, data_lines
from callsift.sources.publish import publish


def clean_rows(docs: DataFrame, text: str = "text", least: int = V.MIN_LENGTH) -> DataFrame:
    """The stateless part: repair, mask, drop short texts. Works on batches and streams."""
    cleaned = apply_modifiers(docs, text, repair_unicode, mask_pii)
    return apply_filter(cleaned, text, score_length, lambda score: long_enough(score, least))


def curate(docs: DataFrame, row_id: str = "id", text: str = "text", least: int = V.MIN_LENGTH) -> DataFrame:
    """Clean rows without later duplicates. Duplicates are judged after masking, so that order is part of the result.

    One lazy plan with one shuffle, by text hash.
    """
    return keep_first_duplicate(clean_rows(docs, text, least), row_id, text)


def staged_rows(docs: DataFrame, text: str = "text", least: int = V.MIN_LENGTH, repair: Callable[[Column], Column] = repair_layers) -> DataFrame:
    """Every row with its clean text and what each stage did to it: _repaired, _masked, _short. Nothing is dropped."""
    repaired = pin(docs, "_fixed", repair(F.col(text)))
    masked = pin(repaired, "_clean", mask_pii(F.col("_fixed")))
    changed = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    flags = {"_repaired": changed(text, "_fixed"), "_masked": changed("_fixed", "_clean"), "_short": ~long_enough(score_length(F.col("_clean")), least)}
    return masked.withColumns(flags).drop(text, "_fixed").withColumnRenamed("_clean", text)


@whole_job
def run_curation(spark: SparkSession, source: str, target: str) -> dict[str, float]:
    """Curate a JSON Lines data set into `target`; returns the rows at every stage.

    rows_in, repaired and masked (texts that a stage changed), too_short, duplicates, kept, removed and the removed share.

    Records stay as they are: only `id` and `text` are replaced, and file_name is added; every other value is cut from its
    line, and of a repeated key the last value counts. The old target stays until the new one is complete. Lines are
    written once with their number, which is their place in (file path, position) order, and once more with the clean text
    and a flag for each stage. The counts are read from those written flags, and the kept rows are counted where they are
    written, so tasks and stages that run again count once.
    """
    lines = number_by_position(data_lines(spark, source), "_position")
    rows_in = check_lines(lines, source)
    found = lines.withColumn("_spans", record_spans("value")).select("value", "_spans", "_position", "file_path")
    staged = settle(staged_rows(pin(found, "text", record_text(F.col("value"), F.col("_spans"), "text"))), "staged")
    counts = staged.agg(*[F.count_if(f"_{name}").alias(name) for name in ("repaired", "masked", "short")]).first()
    kept_rows = keep_first_duplicate(staged.where("NOT _short"), "_position")
    new = {
        "id": padded_id(f"{V.ID_PREFIX}-", F.col("_position"), 10),
        "text": F.col("text"),
        "file_name": F.element_at(F.split("file_path", "/"), -1),
    }
    seen = Observation("curated")
    shown = kept_rows.select(record_line(F.col("value"), F.col("_spans"), new).alias("value"))
    publish(spark, target, shown.observe(seen, F.count("*").alias("kept")).write.text)
    kept, short = seen.get["kept"], counts["short"]
    return {
        "rows_in": rows_in, "repaired": counts["repaired"], "masked": counts["masked"], "too_short": short,
        "duplicates": rows_in - short - kept, "kept": kept, "removed": rows_in - kept, "removed_share": (rows_in - kept) / rows_in,
    }
