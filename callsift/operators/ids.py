"""Consecutive numbers without a single-task window over the rows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions.text import padded_id
from callsift.session import settle


def _number_stored(stored: DataFrame, group: str, block: str, out: str, start: int) -> DataFrame:
    """Number written rows by (group, block, _at): a row's number is the rows before its block plus its place inside.

    Every figure comes from stored values, so it does not matter how the table is split when it is read. Sums are taken
    at two levels, blocks inside their group and groups as a whole, and come back as a joined table of one row per block.
    """
    blocks = stored.groupBy(group, block).agg(F.count("*").alias("_n"), F.min("_at").alias("_least"))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = blocks.withColumn("_inside", before(Window.partitionBy(group).orderBy(block)))
    groups = blocks.groupBy(group).agg(F.sum("_n").alias("_n")).withColumn("_groups", before(Window.orderBy(group))).drop("_n")
    offsets = inside.join(groups, group).select(
        F.col(group).alias("_g"), F.col(block).alias("_b"), (F.col("_groups") + F.col("_inside") - F.col("_least") + start).alias("_offset")
    )
    joined = stored.join(offsets, (F.col(group) == F.col("_g")) & (F.col(block) == F.col("_b")))
    return joined.withColumn(out, (F.col("_offset") + F.col("_at")).cast("bigint")).drop("_g", "_b", "_offset")


def _number_by_row_index(scan: DataFrame, out: str, start: int) -> DataFrame | None:
    """Numbers from the place that a Parquet file gives each of its rows; None where rows have no such place.

    Counts per file come from a scan without columns, that is from the footers. They become a table of one row per file,
    and the rows themselves are not written. None, too, for a plan that leaves out rows of a file, since places would then
    have gaps.
    """
    file, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    try:
        files = scan.groupBy(file.alias("_file")).agg(F.count("*").alias("_n"), F.max(place).alias("_last"))
        placed = scan.select("*", file.alias("_path"), place.alias("_at"))
    except AnalysisException:
        return None
    files = settle(files, "files")
    if not files.where("_n != _last + 1").isEmpty():
        return None
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = files.select(F.col("_file").alias("_path"), (before + start).alias("_offset"))
    return placed.join(offsets, "_path").withColumn(out, (F.col("_offset") + F.col("_at")).cast("bigint")).drop("_path", "_offset", "_at")


def number_by_position(scan: DataFrame, out: str = "row_id", start: int = 0) -> DataFrame:
    """Number the rows of a file scan in the order of (file path, position in the file).

    Rows of Parquet files are numbered by their place in the file. Others are written once with their file, the start of
    their part of it and a running number; all else is read from there. Either way, dynamic allocation, other split
    settings or a late action cannot change a number. A plan that is no file scan (or that has lost sight of its files)
    has no such order and is refused; use number_by_key there. Readers of this library carry file_path and file_block,
    which are used where they are present.
    """
    given = {"file_path", "file_block"} <= set(scan.columns)
    numbered = None if given else _number_by_row_index(scan, out, start)
    if numbered is not None:
        return numbered
    try:
        placed = scan.withColumns(
            {
                "_file": F.col("file_path" if given else "_metadata.file_path"),
                "_block": F.col("file_block" if given else "_metadata.file_block_start"),
                "_at": F.monotonically_increasing_id(),
            }
        )
    except AnalysisException as error:
        raise ValueError("position numbers need a file scan; number this plan by a key") from error
    return _number_stored(settle(placed, "positions"), "_file", "_block", out, start).drop("_file", "_block", "_at")


def number_by_key(
    df: DataFrame, order_by: list[str], out: str = "row_id", start: int = 0, partitions: int | None = None
) -> DataFrame:
    """Number rows 0..n-1 in the order of `order_by`, which must identify a row and should be short.

    A range shuffle and a sort inside the partitions; the sorted rows are written with their place, and sums of partition
    sizes make it a number in the whole. `partitions` (default: Spark's own, with AQE) bounds the work of a task.
    """
    ordered = df.repartitionByRange(partitions, *order_by) if partitions else df.repartitionByRange(*order_by)
    placed = settle(ordered.sortWithinPartitions(*order_by).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    stored = placed.withColumns({"_part": F.shiftright("_at", 33), "_group": F.shiftright("_at", 43)})
    return _number_stored(stored, "_group", "_part", out, start).drop("_group", "_part", "_at")


def _numbered(df: DataFrame, order_by: list[str] | None, out: str, start: int) -> DataFrame:
    return number_by_key(df, order_by, out, start) if order_by else number_by_position(df, out, start)


def add_id(
    df: DataFrame, order_by: list[str] | None = None, out: str = "id", prefix: str = V.ID_PREFIX, start: int = 0
) -> DataFrame:
    """Consecutive prefixed ids, by key order or, for a file scan, by position."""
    numbered = _numbered(df, order_by, "_number", start)
    return numbered.withColumn(out, padded_id(f"{prefix}-", F.col("_number"), 10)).drop("_number")


def position_fallback_id(
    df: DataFrame, call_id: str = "call_id", row_id: str = "id", order_by: list[str] | None = None
) -> DataFrame:
    """Call id, else id, else `CALL_%04d` of the row's position. Columns that the table lacks count as absent."""
    numbered = _numbered(df, order_by, "_number", 0)
    given = [F.col(c).cast("string") for c in (call_id, row_id) if c in df.columns]
    chosen = F.coalesce(*given, padded_id("CALL_", F.col("_number"), 4))
    return numbered.withColumn(call_id, chosen).drop("_number")


def report_row_number(df: DataFrame, order_by: list[str], out: str = "id") -> DataFrame:
    """Running number from 1 in source order."""
    return number_by_key(df, order_by, out, start=1)


def head_n(df: DataFrame, order_by: list[str], rows: int = 200) -> DataFrame:
    """First rows in the given order, as a top-k without a full sort."""
    return df.orderBy(*order_by).limit(rows)
