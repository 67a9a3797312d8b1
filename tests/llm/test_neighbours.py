"""Nearest neighbours against brute force."""

import numpy as np
import pyarrow.parquet as pq

from callsift.llm import neighbours as N
from callsift.llm.queries import QUERIES


def brute(names, rows, queries, k=5):
    """For each query: names and scores of the k nearest other rows."""
    length = np.sqrt((rows * rows).sum(axis=1))
    out = {}
    for i in np.flatnonzero(np.isin(names, queries)):
        score = (rows * rows[i]).sum(axis=1) / (length * length[i])
        best = [j for j in np.lexsort((names, -score)) if names[j] != names[i]][:k]
        out[int(names[i])] = [(int(names[j]), float(score[j])) for j in best]
    return out


def by_query(found):
    out = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_and_scores(spark):
    folder = "/root/testdata/sf0.1"
    data = pq.read_table(f"{folder}/embeddings.parquet").to_pandas()
    rows = np.stack(data["embedding"].values).astype(np.float64)
    wanted = brute(data["vec_id"].values, rows, [x for x in data["vec_id"] if x % 50 == 0])
    got = by_query(QUERIES["op3_nearest"](spark, folder).collect())
    assert set(got) == set(wanted)
    hit = sum(len({a for a, _ in got[q]} & {a for a, _ in wanted[q]}) for q in wanted)
    assert hit >= 0.95 * sum(map(len, wanted.values()))
    exact = {(q, a): s for q in wanted for a, s in wanted[q]}
    assert all(abs(exact[q, a] - s) < 1e-12 for q in got for a, s in got[q] if (q, a) in exact)
    assert all(len(got[q]) == 5 for q in got)


def test_copies_ties_and_unusable_rows(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(x) for x in draw.standard_normal(8)], i) for i in range(60)]
    rows += [(i, [1.0] * 8, i) for i in range(100, 140)] + [(100, [1.0] * 8, 0)]
    bad = [(200, None, 0), (250, [0.0] * 8, 0), (300, [float("nan")] + [1.0] * 7, 0), (350, [None] + [1.0] * 7, 0), (400, [1.0], 0), (None, [1.0] * 8, 0)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, score int").repartition(4)
    got = by_query(N.nearest_neighbours(df, df.where("vec_id % 50 = 0")).collect())
    good = [r for r in rows if r[0] != 100] + [(100, [1.0] * 8, 0)]
    wanted = brute(np.array([r[0] for r in good]), np.array([r[1] for r in good]), [0, 50, 100])
    assert set(got) == {0, 50, 100}
    for q in got:
        assert [a for a, _ in got[q]] == [a for a, _ in wanted[q]]
    assert [a for a, _ in got[100]] == [101, 102, 103, 104, 105]
    few = N.nearest_neighbours(df.where("vec_id < 3"), df.where("vec_id = 0"))
    assert few.count() == 2
    assert N.nearest_neighbours(df.limit(0), df.limit(0)).count() == 0
    assert N.nearest_neighbours(df.where("vec_id = 200"), df.where("vec_id = 200")).columns == ["query_id", "rank", "vec_id", "score"]


def test_recall_over_many_lists(spark, monkeypatch):
    """Lists of about 60 points, so that most are left unread."""
    monkeypatch.setattr(N, "CELL", 60)
    draw = np.random.default_rng(5)
    centres = draw.standard_normal((40, 16))
    rows = centres[draw.integers(0, 40, 3000)] + 0.3 * draw.standard_normal((3000, 16))
    seen, fit = [], N.fit_centroids
    monkeypatch.setattr(N, "fit_centroids", lambda *x: seen.append(fit(*x)) or seen[-1])
    df = spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    got = by_query(N.nearest_neighbours(df, df.where("vec_id % 50 = 0")).collect())
    wanted = brute(np.arange(3000), rows, range(0, 3000, 50))
    centroids, probes = seen[0]
    assert len(centroids) == 50 and probes <= 25, probes
    hit = sum(len({a for a, _ in got[q]} & {a for a, _ in wanted[q]}) for q in wanted)
    assert hit >= 0.95 * sum(map(len, wanted.values()))


def test_lists_of_several_cells_and_groups(spark, monkeypatch):
    """A list that holds a third of the points and is probed by a third of the queries, cut into cells and groups."""
    monkeypatch.setattr(N, "CELL", 100)
    draw = np.random.default_rng(9)
    centres = draw.standard_normal((10, 16))
    which = np.where(draw.random(2000) < 1 / 3, 0, draw.integers(0, 10, 2000))
    rows = centres[which] + 0.3 * draw.standard_normal((2000, 16))
    df = spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    whole = by_query(N.nearest_neighbours(df, df.where("vec_id % 20 = 0")).collect())
    monkeypatch.setattr(N, "CELL_BYTES", 16 * 8 * 25)
    monkeypatch.setattr(N, "GROUP", 7)
    monkeypatch.setattr(N, "GRID", 100)
    got = by_query(N.nearest_neighbours(df, df.where("vec_id % 20 = 0")).collect())
    wanted = brute(np.arange(2000), rows, range(0, 2000, 20))
    assert set(got) == set(whole) == set(wanted)
    for found in (whole, got):
        hit = sum(len({a for a, _ in found[q]} & {a for a, _ in wanted[q]}) for q in wanted)
        assert hit >= 0.95 * sum(map(len, wanted.values()))
        assert all(len(x) == 5 for x in found.values())
