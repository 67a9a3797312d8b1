"""What the operators of this folder share: words and Arrow plumbing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: White space of the contracts: space, tab to carriage return. bytes.split() knows exactly these six.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def utf8(text: str | None) -> bytes:
    """The text's bytes; null is empty. A lone surrogate, which no Parquet string holds, becomes '?'."""
    return b"" if text is None else text.encode("utf-8", "replace")


#: What a worker process keeps from task to task: the stage it is for, and values by name.
_KEPT: dict = {"stage": None, "values": {}}


def kept(name: tuple, make: Callable[[], object]) -> object:
    """One value for each name and worker process, while the worker's tasks belong to one stage."""
    if name not in _KEPT["values"]:
        _KEPT["values"][name] = make()
    return _KEPT["values"][name]


def forget_other_stages() -> None:
    """Drop what was kept for another stage, so that a worker process never holds the tables of two steps at once."""
    stage = TaskContext.get().stageId()
    if _KEPT["stage"] != stage:
        _KEPT.update(stage=stage, values={})
        pa.default_memory_pool().release_unused()


def map_columns(df: DataFrame, make: Callable[[], Callable[[dict], dict | Iterator[dict]]], schema: str | T.StructType) -> DataFrame:
    """Run a function of columns over the Arrow batches of each partition.

    `make` is called once for each partition and gives the function. It gets the input columns as Arrow arrays and returns
    the output columns as lists or Arrow arrays, or yields several such results. Rows need not be as many as before.
    """
    wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_other_stages()
        arrow = to_arrow_schema(wanted)
        work = make()
        for batch in batches:
            if batch.num_rows:
                made = work({name: batch.column(i) for i, name in enumerate(batch.schema.names)})
                for part in [made] if isinstance(made, dict) else made:
                    columns = [(part[f.name], f) for f in arrow]
                    yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, type=f.type) for v, f in columns], schema=arrow)

    return df.mapInArrow(run, wanted)


def rows_of(columns: dict[str, pa.Array], names: tuple[str, ...], at_once: int = 200) -> Iterator[tuple]:
    """The rows of some columns, turned into Python values a few at a time."""
    for start in range(0, len(columns[names[0]]), at_once):
        yield from zip(*(columns[x].slice(start, at_once).to_pylist() for x in names))


def slices(columns: dict[str, pa.Array], at_once: int = 500) -> Iterator[dict[str, pa.Array]]:
    """The columns a few rows at a time, so that only those become Python values."""
    for start in range(0, len(next(iter(columns.values()))), at_once):
        yield {name: column.slice(start, at_once) for name, column in columns.items()}


def portions(values: list, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive values whose lengths sum to about `size`; a longer value is a range of its own."""
    start, total = 0, 0
    for i, value in enumerate(values):
        n = len(value or "")
        if i > start and total + n > size:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(values):
        yield start, len(values)
