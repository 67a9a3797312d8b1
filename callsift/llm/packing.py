"""Concatenate and cut: documents in one long row of tokens, cut into windows of one length."""

from __future__ import annotations

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callsift.llm.base import map_columns, portions, rows_of, slices
from callsift.llm.bpe import CHUNK, vocabulary
from callsift.llm.piece_codec import piece_codec
from callsift.session import settle

LENGTH = 2048
END = 1
#: Partitions whose totals are summed in one group of the first of two levels of prefix sums.
GROUP = 1000


def encoded(df: DataFrame, key: str, text: str, path: str, end: int) -> DataFrame:
    """key, part, before (tokens before it in its partition), n, ids: written once, so that both passes see one order.

    Ids are stored in 16 bits where the vocabulary allows.
    """
    kind = df.schema[key].dataType.simpleString()

    def make():
        tool, part, total = piece_codec(path, end), TaskContext.get().partitionId(), 0
        last = tool.packed([end])

        def work(columns):
            nonlocal total
            for some in slices(columns):
                texts = some["text"].to_pylist()
                for a, b in portions(texts, CHUNK):
                    ids = [x + last for x in tool.encode_all(texts[a:b])]
                    sizes = np.array([len(x) for x in ids], np.int64) // tool.width
                    before = total + np.cumsum(sizes) - sizes
                    total += int(sizes.sum())
                    yield {
                        "key": some["key"].slice(a, b - a), "part": [part] * (b - a), "before": before, "n": sizes,
                        "width": [tool.width] * (b - a), "ids": ids,
                    }

        return work

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return settle(map_columns(rows, make, f"key {kind}, part int, before long, n long, width int, ids binary"), "encoded")


def partition_offsets(rows: DataFrame) -> DataFrame:
    """part, base: tokens in all partitions before it, by prefix sums inside groups of partitions and over the groups."""
    totals = rows.groupBy("part").agg(F.sum("n").alias("n")).withColumn("group", F.floor(F.col("part") / GROUP))
    inside = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = totals.groupBy("group").agg(F.sum("n").alias("all")).withColumn("first", F.coalesce(F.sum("all").over(over), F.lit(0)))
    local = totals.withColumn("local", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return settle(local.join(groups, "group").select("part", (F.col("first") + F.col("local")).alias("base")), "offsets")


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, path: str | None = None, end: int = END) -> DataFrame:
    """Pieces of documents in sequences of `length` tokens; only the last sequence of all can be shorter.

    Returns key, start (tokens of its document before it), length, ids (binary: little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset. A document is its ids, then `end`; null text has `end` alone. Each token lies in
    exactly one piece, repeated rows are documents of their own, an empty table gives no piece.

    First pass: texts are encoded once and written with their place in the partition. Then sums of partition totals give
    every partition its first place in the whole. Second pass: the written rows are cut; no token is shuffled, since the
    table of offsets (a row per partition) is broadcast while its written size allows.
    """
    rows = encoded(df, key, text, path or vocabulary(), end)
    kind = df.schema[key].dataType.simpleString()

    def make():
        def work(columns):
            out = {x: [] for x in ("key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
            size = 0
            for name, at, n, width, ids in rows_of(columns, ("key", "place", "n", "width", "ids")):
                wide = np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    stop = min(n, start + length - offset)
                    for x, value in zip(out, (name, start, stop - start, wide[4 * start : 4 * stop], n, sequence, offset)):
                        out[x].append(value)
                    start = stop
                size += len(wide)
                if size > 16 * CHUNK:
                    yield out
                    out, size = {x: [] for x in out}, 0
            if out["key"]:
                yield out

        return work

    placed = rows.join(partition_offsets(rows), "part").select("key", (F.col("base") + F.col("before")).alias("place"), "n", "width", "ids")
    schema = f"key {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return map_columns(placed, make, schema).withColumnRenamed("key", key)
