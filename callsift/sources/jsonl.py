"""JSON Lines in and out. A data set is a file or a directory of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callsift.functions.jsontext import OPTIONS, has_key, is_json, value_at
from callsift.functions.text import strip
from callsift.session import settle
from callsift.sources.publish import publish

DOCUMENT = "call_id STRING, id STRING, text STRING, is_clean BOOLEAN, noise_type STRING"
RAW_CALL = "call_id STRING, id STRING, text STRING, response STRING"
GOLD = "id STRING, label STRING, fraud_type STRING, ground_truth STRING, score INT"
PAIR = "input STRING, output STRING"


def _all_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, the start of their part of it, and a position that keeps the order inside that part."""
    return spark.read.text(path).select(
        strip(F.col("value")).alias("value"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_block"),
        F.monotonically_increasing_id().alias("position"),
    )


def data_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines that are not blank."""
    return _all_lines(spark, path).where("value <> ''")


PLACE = ["file_path", "file_block", "position"]


def _parsed(lines: DataFrame, schema: str, keep: list[str] | None = None) -> DataFrame:
    return lines.select(F.from_json("value", schema, OPTIONS).alias("_row"), *(keep or [])).select("_row.*", *(keep or []))


def read_jsonl_lenient(spark: SparkSession, path: str, schema: str = RAW_CALL, with_order: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, bad lines): bad JSON is set aside with file, position and text. A missing path gives no rows.

    `with_order` adds the record's place (file_path, file_block, position).
    """
    try:
        lines = data_lines(spark, path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        kinds = "value string, file_path string, file_block bigint, position bigint"
        lines = spark.createDataFrame([], kinds)
    good = is_json(F.col("value"))
    rows = _parsed(lines.where(good), schema, ["value", *(PLACE if with_order else [])])
    if "text" in rows.columns:  # a number or other value is no text
        kind = F.schema_of_variant(value_at(F.col("value"), ".text", "variant"))
        rows = rows.withColumn("text", F.when(F.coalesce(kind, F.lit("STRING")) == "STRING", F.col("text")))
    return rows.drop("value"), lines.where(~good)


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """file_path, line (from 1, blank lines included) and text of every line that is no JSON.

    One pass writes the place of every line and the text of the bad ones; line numbers are counted from that table.
    """
    lines = _all_lines(spark, path)
    bad = F.when((F.col("value") != "") & ~is_json(F.col("value")), F.col("value"))
    places = settle(lines.select("file_path", "file_block", "position", bad.alias("value")), "lines")
    blocks = places.groupBy("file_path", "file_block").agg(F.count("*").alias("n"), F.min("position").alias("least"))
    above = Window.partitionBy("file_path").orderBy("file_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("above", F.coalesce(F.sum("n").over(above), F.lit(0))).drop("n")
    found = places.where("value IS NOT NULL").join(blocks, ["file_path", "file_block"])
    return found.select("file_path", (F.col("above") + F.col("position") - F.col("least") + 1).alias("line"), "value")


def validate_jsonl(lines: DataFrame, key: str = "text") -> DataFrame:
    """One row: lines, lines that are no JSON, JSON lines without the key (a null value has the key)."""
    good = is_json(F.col("value"))
    return lines.agg(
        F.count("*").alias("total"), F.count_if(~good).alias("bad_json"), F.count_if(good & ~has_key(F.col("value"), key)).alias("missing_key")
    )


def check_lines(lines: DataFrame, path: str, key: str = "text") -> int:
    """The number of lines; an error if any is no JSON or lacks the key, or if there is none."""
    found = validate_jsonl(lines, key).first()
    if found["bad_json"] or found["missing_key"]:
        raise ValueError(f"{path}: {found['bad_json']} lines are no JSON, {found['missing_key']} lack '{key}'")
    if not found["total"]:
        raise ValueError(f"{path}: no records")
    return found["total"]


def read_jsonl_strict(
    spark: SparkSession, path: str, schema: str = DOCUMENT, key: str = "text"
) -> tuple[DataFrame, int]:
    """(records, number of records). Fails on a missing path, bad JSON, a missing key or no records at all."""
    lines = data_lines(spark, path)
    total = check_lines(lines, path, key)
    return _parsed(lines, schema), total


def read_jsonl_plain(spark: SparkSession, path: str, schema: str = DOCUMENT, with_order: bool = False) -> DataFrame:
    """Records of the non-blank lines; bad JSON fails the job. `with_order` adds file_path, file_block and position."""
    lines = data_lines(spark, path)
    bad = F.raise_error(F.concat(F.lit("no JSON: "), F.col("value")))
    checked = lines.where(F.when(is_json(F.col("value")), F.lit(True)).otherwise(bad.cast("boolean")))
    return _parsed(checked, schema, PLACE if with_order else None)


def read_documents(spark: SparkSession, path: str, schema: str = DOCUMENT) -> DataFrame:
    """Documents with the name of the file they came from; a line that is no JSON fails the job."""
    rows = spark.read.schema(schema).options(mode="FAILFAST", **OPTIONS).json(path)
    return rows.select("*", F.col("_metadata.file_name").alias("file_name"))


def write_jsonl(df: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON object per line, UTF-8, null fields kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_curated(df: DataFrame, path: str) -> None:
    """Replace the old output when the new one is complete. The directory as a whole is the data set; every part is kept."""
    publish(df.sparkSession, path, lambda beside: write_jsonl(df, beside))
