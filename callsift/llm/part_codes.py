"""Vector codes by parts: codebooks of integer parts, fitted and applied over a trie of the distinct parts.

Parts are walked in lexicographic order. A node of the trie holds one number per codebook entry, the squared distance over
the components so far; parts that begin alike share it. At a leaf the numbers are the whole distances: the least names the
entry, and the part is added to that entry's sum as often as it occurs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsift.llm.base import map_columns
from callsift.session import settle

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components are kept in 32 bits; a vector with one beyond takes no part, since its errors would not fit a long.
MOST = 1 << 27
#: Numbers that are held at once for the children of one node.
AT_ONCE = 1 << 20


def trie_scan(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of each row of `parts`: integers, distinct, in lexicographic order.

    Depth first over the trie. A node's children are taken together: their numbers are those of the node plus the squared
    differences in one more component. Where a child holds a single part, the rest of its components follows at once.
    Numbers are whole, so the result is exact; ties go to the lower entry.
    """
    n, width = parts.shape
    code, error = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n:
        return code, error
    parts, entries = parts.astype(np.int64), entries.astype(np.int64)
    step = max(1, AT_ONCE // len(entries))
    stack = [(0, n, 0, np.zeros(len(entries), np.int64))]
    while stack:
        first, last, depth, so_far = stack.pop()
        if depth == width:
            code[first:last], error[first:last] = so_far.argmin(), so_far.min()
            continue
        column = parts[first:last, depth]
        begin = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]])) + first
        end = np.append(begin[1:], last)
        lone = end - begin == 1
        for at in range(0, lone.sum(), step):
            rows = begin[lone][at : at + step]
            total = np.repeat(so_far[None, :], len(rows), axis=0)
            for d in range(depth, width):
                total += (parts[rows, d, None] - entries[None, :, d]) ** 2
            code[rows] = total.argmin(axis=1)
            error[rows] = total.min(axis=1)
        for a, b in zip(begin[~lone][::-1].tolist(), end[~lone][::-1].tolist()):
            stack.append((a, b, depth + 1, so_far + (parts[a, depth] - entries[:, depth]) ** 2))
    return code, error


def sorted_distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, and the number of the one that each row is."""
    order = np.lexsort(parts.T[::-1])
    ordered = parts[order]
    new = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(axis=1)])
    which = np.empty(len(parts), np.int64)
    which[order] = np.cumsum(new) - 1
    return ordered[new], which


def stored(parts: np.ndarray) -> list[bytes]:
    """Parts as bytes that sort as their components do."""
    return [row.tobytes() for row in (parts.astype(np.int64) + (1 << 31)).astype(">u4")]


def loaded(data: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(x, ">u4") for x in data]).astype(np.int64) - (1 << 31)


@dataclass
class Codebooks:
    """One array (entry x component) of each part position, and how vectors are scaled and cut."""

    books: list[np.ndarray]
    scale: int
    dimension: int

    def text(self) -> str:
        """All components by part, entry and position, joined by commas."""
        return ",".join(str(x) for book in self.books for x in book.ravel().tolist())

    def borders(self) -> list[int]:
        return part_borders(self.dimension, len(self.books))


def part_borders(dimension: int, parts: int) -> list[int]:
    """Where parts begin and end: equal ones, or the first ones longer by one where the dimension is not divisible."""
    sizes = [dimension // parts + (i < dimension % parts) for i in range(parts)]
    return [0, *np.cumsum(sizes).tolist()]


def whole_numbers(vectors: DataFrame, vector: str, scale: int, dimension: int) -> DataFrame:
    """The rows that take part, with `whole` (binary): the vector's components as integers that sort as the vector does."""
    fields = vectors.schema.fields
    names = [f"c{i}" for i in range(len(fields))]
    rows = vectors.select(*[F.col(f"`{f.name}`").alias(n) for f, n in zip(fields, names)], F.col(f"`{vector}`").cast("array<double>").alias("v"))
    rows = rows.where((F.size("v") == dimension) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(F.floor(x * scale).cast("double")) > MOST) | (F.abs(x) > MOST)))

    def make():
        def work(columns):
            flat = columns["v"].flatten().to_numpy().reshape(-1, dimension)
            return {n: columns[n] for n in names} | {"whole": stored(np.floor(flat * scale))}

        return work

    inner = [T.StructField(n, f.dataType, f.nullable) for n, f in zip(names, fields)]
    return map_columns(rows, make, T.StructType([*inner, T.StructField("whole", T.BinaryType())]))


def main_dimension(df: DataFrame, vector: str) -> int:
    """The length of most vectors (the smaller one if equal); 0 without any."""
    sizes = df.where(F.col(f"`{vector}`").isNotNull()).groupBy(F.size(f"`{vector}`").alias("d")).count().where("d > 0")
    found = sizes.orderBy(F.desc("count"), "d").first()
    return found["d"] if found else 0


def refined(distinct: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Every entry replaced by the floor of the mean of the parts that are nearest to it; unused entries stay.

    `distinct`: position, part, copies. A task sends one sum per entry and component, and the driver gets as many.
    """
    shared = distinct.sparkSession.sparkContext.broadcast(books)

    def make():
        def work(columns):
            position, copies = columns["position"].to_numpy(), columns["copies"].to_numpy()
            out = {x: [] for x in ("position", "entry", "component", "total", "count")}
            for p in np.unique(position).tolist():
                some = np.flatnonzero(position == p)
                parts, which = sorted_distinct(loaded(columns["part"].take(pa.array(some)).to_pylist()))
                weight = np.zeros(len(parts), np.int64)
                np.add.at(weight, which, copies[some])
                code, _ = trie_scan(parts, shared.value[p])
                used, code = np.unique(code, return_inverse=True)
                width, kind = parts.shape[1], np.int64 if weight.sum() < (1 << 62) // MOST else object  # else whole numbers of any size
                count, total = np.zeros(len(used), kind), np.zeros((len(used), width), kind)
                np.add.at(count, code, weight.astype(kind))
                np.add.at(total, code, parts.astype(kind) * weight.astype(kind)[:, None])
                out["position"] += [p] * total.size
                out["entry"] += np.repeat(used, width).tolist()
                out["component"] += list(range(width)) * len(used)
                out["total"] += [str(x) for x in total.ravel().tolist()]
                out["count"] += np.repeat(count, width).tolist()
            return out

        return work

    sums = map_columns(distinct, make, "position int, entry int, component int, total string, count long")
    whole = sums.groupBy("position", "entry", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("count").alias("count"))
    after = [book.copy() for book in books]
    for r in whole.collect():
        after[r["position"]][r["entry"], r["component"]] = int(r["total"]) // r["count"]
    return after


def fit_codebooks(df: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """Codebooks of all vectors, started from those with the smallest keys (null keys last, equal ones by components)."""
    dimension = main_dimension(df, vector)
    edges = part_borders(dimension, parts)
    rows = settle(whole_numbers(df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{vector}`").alias("v")), "v", scale, dimension).select(F.col("c0").alias("k"), "whole"), "vectors")
    first = rows.orderBy(F.col("k").asc_nulls_last(), "whole").limit(entries).collect()
    if not first:
        return Codebooks([np.zeros((0, b - a), np.int64) for a, b in zip(edges, edges[1:])], scale, dimension)
    start = loaded([bytes(r["whole"]) for r in first])
    books = [start[:, a:b] for a, b in zip(edges, edges[1:])]
    cut = [F.struct(F.lit(p).alias("position"), F.substring("whole", 4 * a + 1, 4 * (b - a)).alias("part")) for p, (a, b) in enumerate(zip(edges, edges[1:]))]
    pieces = rows.select(F.inline(F.array(*cut))).groupBy("position", "part").agg(F.count("*").alias("copies"))
    distinct = settle(pieces.repartitionByRange("position", "part").sortWithinPartitions("position", "part"), "parts")
    for _ in range(rounds):
        books = refined(distinct, books)
    return Codebooks(books, scale, dimension)


def encode_vectors(df: DataFrame, model: Codebooks, vector: str = "embedding") -> DataFrame:
    """Every row that takes part, with codes (binary: a byte or, over 256 entries, four, per part) and error (long).

    The parts of an Arrow batch are put in order and walked as one trie per position; no shuffle.
    """
    edges, dimension = model.borders(), model.dimension
    fields = [f for f in df.schema.fields if f.name not in ("codes", "error")]
    shared = df.sparkSession.sparkContext.broadcast(model.books)
    small = len(model.books[0]) <= 256
    rows = whole_numbers(df.select(*[F.col(f"`{f.name}`") for f in fields]), vector, model.scale, dimension)
    names = [f"c{i}" for i in range(len(fields))]

    def make():
        def work(columns):
            whole = loaded(columns["whole"].to_pylist())
            codes, errors = [], 0
            for book, a, b in zip(shared.value, edges, edges[1:]):
                parts, which = sorted_distinct(whole[:, a:b])
                code, error = trie_scan(parts, book)
                codes.append(code[which])
                errors = errors + error[which]
            table = np.stack(codes, axis=1).astype(np.uint8 if small else ">u4")
            return {n: columns[n] for n in names} | {"codes": [row.tobytes() for row in table], "error": errors}

        return work

    inner = [T.StructField(n, f.dataType, f.nullable) for n, f in zip(names, fields)]
    out = map_columns(rows, make, T.StructType([*inner, T.StructField("codes", T.BinaryType()), T.StructField("error", T.LongType())]))
    return out.select(*[F.col(n).alias(f.name) for n, f in zip(names, fields)], "codes", "error")


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", **options) -> tuple[DataFrame, Codebooks]:
    """(rows with codes and error, codebooks) of a table of vectors.

    A vector's components x become floor(scale * x); vectors are cut into `parts` consecutive parts, each position with a
    codebook of its own. Vectors that are null, hold null or non-finite components, have another length than most, or a
    scaled component beyond MOST take no part. Nearest entries are by squared distance, ties to the lower entry. Repeated
    rows are rows of their own (they count in the means and come out as often), null keys are the last. With fewer rows
    than `entries` the codebooks are as short; an empty table gives no row and empty codebooks. Other columns pass
    through; those named codes or error are replaced.

    Copies of a part are counted before they are shuffled, so a group of copies is one row per task. Rounds read the
    written distinct parts and shuffle only sums.
    """
    model = fit_codebooks(df, key, vector, **options)
    return encode_vectors(df, model, vector), model
