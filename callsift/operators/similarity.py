"""Similarity of the two texts of a row: cosine of hashed term vectors weighted by document frequency."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Slots that terms are hashed to. Fixed, so that the table of weights never grows with the vocabulary.
SLOTS = 1 << 18
#: Rows that are compared at once in a task.
AT_ONCE = 500


def terms(text: Column) -> Column:
    """The terms (runs of letters and digits, lower case) of a text with one space between; empty for null."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def slots_of(texts: pa.Array, slots: int) -> pa.ListArray:
    """The slot of every term, repeats included, for each row of `terms`; a term is hashed once for all rows."""
    words = pc.split_pattern(texts, " ")
    kept = pc.greater(pc.binary_length(words.flatten()), 0)  # a text without a term is split into one empty string
    sizes = np.where(pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), words.value_lengths().to_numpy(zero_copy_only=False), 0)
    found = words.flatten().filter(kept).dictionary_encode()
    slot = np.array([int.from_bytes(md5(t).digest()[:4]) % slots for t in found.dictionary.cast(pa.binary()).to_pylist()], np.int32)
    edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(edges, pa.array(slot[found.indices.to_numpy()], pa.int32()))


def lists_of(column: pa.Array, slots: int) -> Iterator[pa.ListArray]:
    """Lists of slots for `AT_ONCE` rows at a time; `column` holds such lists already, or `terms`."""
    for at in range(0, len(column), AT_ONCE):
        some = column.slice(at, AT_ONCE)
        yield some if pa.types.is_list(some.type) else slots_of(some, slots)


def _prepared(df: DataFrame, name: str) -> Column:
    column = F.col(f"`{name}`")
    return F.coalesce(column, F.array().cast("array<int>")) if isinstance(df.schema[name].dataType, T.ArrayType) else terms(column)


def term_slots(text: Column, slots: int = SLOTS) -> Column:
    """The slot of every term (run of letters and digits, lower case) of a text, repeats included; none for null."""

    @F.arrow_udf("array<int>")
    def listed(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array([], pa.list_(pa.int32())), *lists_of(texts, slots)])

    return listed(terms(text))


def slot_weights(df: DataFrame, texts: list[str], slots: int = SLOTS) -> np.ndarray:
    """ln((1 + n) / (1 + documents with the slot)) + 1 for each slot, over n documents.

    Every text of the columns `texts` (strings, or their `term_slots`) is a document, also one without a term. A task sends
    one count per slot at most, and the driver gets `slots` counts at most, whatever the corpus.
    """

    def count(batches):
        held = np.zeros(slots + 1, np.int64)  # the last place is held by every document
        for batch in batches:
            for column in batch.columns:
                for lists in lists_of(column, slots):
                    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                    keys = np.unique(np.repeat(np.arange(len(lists)), sizes) * slots + lists.flatten().to_numpy())
                    held[:-1] += np.bincount(keys % slots, minlength=slots)
                    held[-1] += len(lists)
        where = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), pa.array(held[where], pa.int64())], names=["slot", "n"])

    prepared = df.select(*[_prepared(df, t).alias(f"t{i}") for i, t in enumerate(texts)])
    counts = prepared.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros(slots + 1)
    found[counts["slot"].to_numpy()] = counts["n"].to_numpy()
    return np.log((1 + found[-1]) / (1 + found[:-1])) + 1


def cosines(left: pa.ListArray, right: pa.ListArray, weights: np.ndarray) -> np.ndarray:
    """Cosine of two weighted count vectors, given as lists of slots, for each row; NaN where a list is empty."""
    n, slots = len(left), len(weights)

    def vectors(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        keys, counts = np.unique(np.repeat(np.arange(n), sizes) * slots + lists.flatten().to_numpy(), return_counts=True)
        x = counts * weights[keys % slots]
        return keys, x, np.sqrt(np.bincount(keys // slots, x * x, n))

    (keys, x, norm), (others, y, other) = vectors(left), vectors(right)
    both, i, j = np.intersect1d(keys, others, assume_unique=True, return_indices=True)
    with np.errstate(invalid="ignore"):
        return np.minimum(np.bincount(both // slots, x[i] * y[j], n) / (norm * other), 1.0)


def text_similarity(df: DataFrame, left: str, right: str, out: str = "similarity", slots: int = SLOTS) -> DataFrame:
    """Every row with `out`: cosine of its two texts, 0 to 1; null when one of them has no term (null and empty texts).

    A column is a text or the `term_slots` of one: where a text stands in several rows, hash it once and join the slots.

    A first pass over both columns, run when this is called, counts documents per slot; the second is narrow: the weights
    (`slots` numbers, whatever the corpus) are broadcast, and no term is shuffled. Repeated rows count as often as they are
    there; an empty table stays empty. A column named like `out` is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(slot_weights(df, [left, right], slots))

    @F.arrow_udf("double")
    def close(a: pa.Array, b: pa.Array) -> pa.Array:
        parts = [cosines(x, y, shared.value) for x, y in zip(lists_of(a, slots), lists_of(b, slots))]
        return pa.array(np.concatenate([np.zeros(0), *parts]), pa.float64(), from_pandas=True)

    return df.withColumn(out, close(*[_prepared(df, name) for name in (left, right)]))


def mean_similarity(df: DataFrame, column: str = "similarity") -> DataFrame:
    """One row: mean of the known similarities, how many are known, and all rows."""
    return df.agg(F.avg(column).alias("mean_similarity"), F.count(column).alias("compared"), F.count("*").alias("total"))
