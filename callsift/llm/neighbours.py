"""Nearest neighbours by cosine: probed lists, and in each an adaptive scan over rotated column blocks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callsift.llm.base import map_columns, slices
from callsift.session import settle

#: Rows that centroids and the number of probes are fitted on, about.
SAMPLE = 20_000
#: Distinct vectors per list, about, up to MOST_LISTS lists.
CELL = 2048
MOST_LISTS = 4096
#: What one task holds at a time, about: bytes of a list's vectors (a cell), and queries of a list (a group). A list of more is
#: scanned cell by cell and group by group; most lists are one cell and one group, so that a row is sent once a list.
CELL_BYTES, GROUP = 1 << 24, 4096
#: Partial distances that a scan holds at once.
GRID = 1 << 22
#: Share of the true neighbours that the probed lists must hold on the sample.
RECALL = 0.98
BLOCK = 16
#: Strictness of the hypothesis test: larger abandons fewer candidates.
STRICTNESS = 2.1


@dataclass
class Index:
    """centroids (list x dimension), probes, rotation (dimension x dimension), and for each list its first place, cells and groups.

    A place is one cell against one group of queries.
    """

    centroids: np.ndarray
    probes: int
    rotation: np.ndarray
    first: np.ndarray
    cells: np.ndarray
    groups: np.ndarray


def unit_rows(data: list[bytes]) -> np.ndarray:
    rows = np.stack([np.frombuffer(x, "<f8") for x in data])
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def fit_centroids(rows: np.ndarray, lists: int, k: int) -> tuple[np.ndarray, int]:
    """Spherical k-means on the sample, and the fewest probes that keep RECALL of the sample's own neighbours."""
    draw = np.random.default_rng(7)
    centroids = rows[draw.choice(len(rows), min(lists, len(rows)), replace=False)]
    for _ in range(10):
        nearest = (rows @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, rows)
        norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centroids = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centroids)
    nearest = (rows @ centroids.T).argmax(axis=1)
    tests = draw.choice(len(rows), min(500, len(rows)), replace=False)
    close = rows[tests] @ rows.T
    close[np.arange(len(tests)), tests] = -2
    top = np.argsort(-close, axis=1)[:, :k]
    place = np.argsort(np.argsort(-(rows[tests] @ centroids.T), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(place, nearest[top], axis=1).ravel())
    return centroids, int(needed[int(np.ceil(RECALL * len(needed))) - 1]) + 1


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """key (long), vec (binary, doubles) of the rows that take part: no null, non-finite or all-zero vector, one dimension.

    The dimension is that of most rows (smaller one if equal); vectors of another take no part.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("v")).where("key IS NOT NULL AND v IS NOT NULL")
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").where("d > 0").first()
    dimension = sizes["d"] if sizes else 0

    def make():
        def work(columns):
            keys, found = [], []
            for name, value in zip(columns["key"].to_pylist(), columns["v"].to_pylist()):
                if len(value) == dimension and None not in value:
                    row = np.array(value, "<f8")
                    if np.isfinite(row).all() and row.any() and np.isfinite(row @ row) and row @ row > 0:
                        keys.append(name)
                        found.append(row.tobytes())
            return {"key": keys, "vec": found}

        return work

    return map_columns(rows, make, "key long, vec binary")


def spread(names: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """A part from 0 to parts - 1 for each name."""
    return ((names.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts


def scan_cell(base: np.ndarray, names: np.ndarray, queries: np.ndarray, rotation: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query, base row, cosine) of the k best of a cell for each query, ties to the smaller name.

    Unit vectors are rotated and cut into column blocks. After each block, a candidate whose scaled partial distance is
    beyond the k-th best distance so far by more than the test allows is abandoned. Survivors are scored on the original
    vectors in double precision.
    """
    length = np.sqrt((base * base).sum(axis=1))
    of_query = np.sqrt((queries * queries).sum(axis=1))
    rotated, turned = (base / length[:, None]) @ rotation, (queries / of_query[:, None]) @ rotation
    d = base.shape[1]
    edges = [*range(0, d, BLOCK), d]
    blocks = [np.ascontiguousarray(rotated[:, a:b]) for a, b in zip(edges, edges[1:])]
    parts = [turned[:, a:b] for a, b in zip(edges, edges[1:])]
    size, at_once = (blocks[0] ** 2).sum(axis=1), max(1, GRID // max(1, len(base)))
    found = []
    for j in range(len(queries)):
        if j % at_once == 0:
            some = parts[0][j : j + at_once]
            first = size - 2 * some @ blocks[0].T + (some**2).sum(axis=1)[:, None]
        partial = first[j % at_once]
        start = np.argpartition(partial, min(4 * k, len(base)) - 1)[: 4 * k]
        whole = ((rotated[start] - turned[j]) ** 2).sum(axis=1)
        limit = np.sort(whole)[min(k, len(whole)) - 1] if len(base) > k else np.inf
        alive = np.arange(len(base))
        for b, seen in enumerate(edges[1:]):
            if b:
                partial = partial + ((blocks[b][alive] - parts[b][j]) ** 2).sum(axis=1)
            test = limit * (1 + STRICTNESS / np.sqrt(seen)) ** 2 if seen < d else limit
            keep = partial * (d / seen) <= test + 1e-9
            alive, partial = alive[keep], partial[keep]
        score = (base[alive] * queries[j]).sum(axis=1) / (length[alive] * of_query[j])
        best = np.lexsort((names[alive], -score))[:k]
        found += [(j, int(alive[x]), float(score[x])) for x in best]
    return found


def nearest_neighbours(df: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """query_id, rank (from 1), key, score: for each row of `queries` (a subset of df's rows) its k nearest other rows.

    Equal vectors are one point that knows its k + 1 smallest keys, the only ones that a result can hold, so groups of
    copies cost nothing; a query's own key is no result, also where it repeats. Centroids and the number of probes come
    from about `sample` points; every point is in the index. A query is sent to the lists that it probes; lists of over
    CELL_BYTES are divided into cells, and queries of a list into groups of about GROUP, each cell scanned against each
    group, so that a list may hold any share of the points or queries. Equal scores are in order of the key. An empty
    table gives no row. Unusable vectors (see `usable`) take no part.
    """
    spark = df.sparkSession
    rows = settle(usable(df, key, vector), "vectors")

    def smallest():
        def work(columns):
            best: dict[bytes, list] = {}
            for name, value in zip(columns["key"].to_pylist(), columns["vec"].to_pylist()):
                best.setdefault(value, []).append(name)
            return {"vec": list(best), "some": [sorted(set(x))[: k + 1] for x in best.values()]}

        return work

    some = map_columns(rows, smallest, "vec binary, some array<long>").groupBy("vec").agg(F.flatten(F.collect_list("some")).alias("some"))
    points = settle(some.select("vec", F.slice(F.array_sort(F.array_distinct("some")), 1, k + 1).alias("keys")).withColumn("point", F.col("keys")[0]), "points")
    n = points.count()
    wanted = "query_id long, rank int, key long, score double"
    if not n:
        return spark.createDataFrame([], wanted).withColumnRenamed("key", key)
    drawn = points.where(F.pmod(F.xxhash64("vec"), F.lit(1 << 30)) <= F.lit(min(1.0, sample / n)) * (1 << 30)).select("vec").toPandas()["vec"]
    fitted = unit_rows(sorted(map(bytes, drawn))) if len(drawn) else unit_rows([bytes(points.first()["vec"])])
    centroids, probes = fit_centroids(fitted, max(1, min(MOST_LISTS, n // CELL)), k)
    centres = spark.sparkContext.broadcast(centroids)

    def assign():
        return lambda columns: {
            "vec": columns["vec"], "point": columns["point"],
            "list": (unit_rows(columns["vec"].to_pylist()) @ centres.value.T).argmax(axis=1).astype(np.int32),
        }

    listed = settle(map_columns(points.select("vec", "point"), assign, "vec binary, point long, list int"), "lists")
    sizes = np.zeros(len(centroids), np.int64)
    for r in listed.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    d = centroids.shape[1]
    asked = settle(queries.select(F.col(key).cast("long").alias("query_id")).where("query_id IS NOT NULL").distinct().join(rows, F.col("query_id") == F.col("key")).select("query_id", "vec").distinct(), "queries")
    distinct = settle(asked.groupBy("vec").agg(F.min("query_id").alias("query")), "distinct-queries")

    def probed(vectors: list, centres: np.ndarray) -> np.ndarray:
        return np.argsort(-(unit_rows(vectors) @ centres.T), axis=1, kind="stable")[:, :probes]

    def lists_asked():
        return lambda columns: {"list": probed(columns["vec"].to_pylist(), centres.value).ravel().astype(np.int32)}

    wanted_by = np.zeros(len(centroids), np.int64)
    for r in map_columns(distinct.select("vec"), lists_asked, "list int").groupBy("list").count().collect():
        wanted_by[r["list"]] = r["count"]
    cells, groups = np.maximum(1, -(-sizes // max(1, CELL_BYTES // (8 * d)))), np.maximum(1, -(-wanted_by // GROUP))
    rotation = np.linalg.qr(np.random.default_rng(11).standard_normal((d, d)))[0]
    shared = spark.sparkContext.broadcast(Index(centroids, probes, rotation, np.cumsum(cells * groups) - cells * groups, cells, groups))

    def every(start: np.ndarray, step: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row `times` places from `start` on, `step` apart: the row and the place."""
        row = np.repeat(np.arange(len(times)), times)
        return row, start[row] + (np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)) * step[row]

    def place():
        def work(columns):
            index, lists = shared.value, columns["list"].to_numpy()
            cell = spread(columns["point"].to_numpy(), index.cells[lists])
            row, at = every(index.first[lists] + cell * index.groups[lists], np.ones(len(lists), np.int64), index.groups[lists])
            return {"cell": at, "point": columns["point"].take(pa.array(row)), "vec": columns["vec"].take(pa.array(row))}

        return work

    def probe():
        def work(columns):
            for some in slices(columns):
                index, lists = shared.value, probed(some["vec"].to_pylist(), centres.value)
                owner, lists = np.repeat(np.arange(len(lists)), lists.shape[1]), lists.ravel()
                group = spread(some["query"].to_numpy()[owner], index.groups[lists])
                row, at = every(index.first[lists] + group, index.groups[lists], index.cells[lists])
                take = pa.array(owner[row])
                yield {"cell": at, "query": some["query"].take(take), "vec": some["vec"].take(take)}

        return work

    base = map_columns(listed, place, "cell long, point long, vec binary")
    routed = map_columns(distinct, probe, "cell long, query long, vec binary")

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            stack = lambda t: np.frombuffer(b"".join(t.column("vec").to_pylist()), "<f8").reshape(t.num_rows, -1)
            names, asked_here = left.column("point").to_numpy(), right.column("query").to_pylist()
            found = [(asked_here[q], int(names[i]), s) for q, i, s in scan_cell(stack(left), names, stack(right), shared.value.rotation, k + 1)]
        columns = list(zip(*found)) or [[], [], []]
        return pa.table({"query": pa.array(columns[0], pa.int64()), "point": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    close = base.groupBy("cell").cogroup(routed.groupBy("cell")).applyInArrow(scan, "query long, point long, score double")
    by_query = Window.partitionBy("query").orderBy(F.desc("score"), "point")
    best = close.withColumn("place", F.row_number().over(by_query)).where(F.col("place") <= k + 1).drop("place")
    named = settle(best.join(points.select("point", "keys"), "point"), "nearest")
    lists = named.groupBy("query").agg(F.collect_list(F.struct("score", "keys")).alias("near"))
    whole = settle(distinct.join(lists, "query").select("vec", "near"), "answers")
    per_row = asked.join(whole, "vec").select("query_id", "near")
    pairs = F.flatten(F.transform("near", lambda x: F.transform(x["keys"], lambda y: F.struct((-x["score"]).alias("score"), y.alias("key")))))
    others = F.array_sort(F.filter(pairs, lambda x: x["key"] != F.col("query_id")))
    out = per_row.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("rank", "x"))
    return out.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.key").alias(key), (-F.col("x.score")).alias("score"))
