"""Vector codes against a plain version of the rounds."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from callsift.llm import part_codes
from callsift.llm.part_codes import compress, sorted_distinct, trie_scan

SCHEMA = "vec_id long, embedding array<double>, label int, codes string, c0 int, whole int"


def plain(rows, entries, rounds, parts=4):
    """vec_id -> (codes, error) and the final codebooks, one vector at a time."""
    whole = [(name, [math.floor(1024 * x) for x in v]) for name, v in rows]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(whole[0][1]) // parts
    piece = lambda v, p: v[p * width : (p + 1) * width]
    books = [[piece(v, p) for _, v in whole[:entries]] for p in range(parts)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(piece(v, p), e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        made = []
        for p in range(parts):
            groups = {}
            for _, v in whole:
                groups.setdefault(nearest(v, p)[1], []).append(piece(v, p))
            made.append([[sum(x) // len(groups[i]) for x in zip(*groups[i])] if i in groups else e for i, e in enumerate(books[p])])
        books = made
    found = [[nearest(v, p) for p in range(parts)] for _, v in whole]
    return sorted((-1 if n is None else n, bytes(i for _, i in f), sum(d for d, _ in f)) for (n, _), f in zip(whole, found)), books


@pytest.mark.parametrize("width,values,entries", [(1, 5, 3), (4, 3, 7), (6, 1000, 40), (3, 2, 1)])
def test_trie_finds_the_nearest_entry(width, values, entries):
    draw = np.random.default_rng(width)
    parts, which = sorted_distinct(draw.integers(-values, values, (500, width)))
    book = draw.integers(-values, values, (entries, width))
    book[-1] = book[0]  # a tie goes to the lower entry
    code, error = trie_scan(parts, book)
    whole = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (code == whole.argmin(axis=1)).all() and (error == whole.min(axis=1)).all()
    assert len(which) == 500 and (np.diff(np.unique(parts, axis=0), axis=0) != 0).any(axis=1).all()


def test_numbers_at_once_change_nothing(monkeypatch):
    draw = np.random.default_rng(4)
    parts, _ = sorted_distinct(draw.integers(-9, 9, (300, 4)))
    book = draw.integers(-9, 9, (20, 4))
    wanted = trie_scan(parts, book)
    monkeypatch.setattr(part_codes, "AT_ONCE", 1)
    assert all((a == b).all() for a, b in zip(trie_scan(parts, book), wanted))


def test_codes_like_the_plain_rounds(spark):
    draw = np.random.default_rng(9)
    vectors = [(i, draw.normal(0, 0.3, 8).round(3).tolist()) for i in range(60)]
    vectors += [(100 + i, vectors[3][1]) for i in range(40)] + [(7, vectors[7][1]), (7, vectors[8][1]), (None, vectors[9][1])]
    bad = [(200, None), (201, [0.1] * 7 + [None]), (202, [math.nan] * 8), (203, [math.inf] + [0.0] * 7), (204, [0.5] * 5), (205, [-math.inf] * 8), (206, [1e30] * 8)]
    rows = [(n, v, 1, "x", 5, 6) for n, v in vectors + bad]
    found, model = compress(spark.createDataFrame(rows, SCHEMA).repartition(5), entries=12, rounds=3)
    assert found.columns == ["vec_id", "embedding", "label", "c0", "whole", "codes", "error"]
    got = found.collect()
    wanted, books = plain(vectors, 12, 3)
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"], bytes(r["codes"]), r["error"]) for r in got) == wanted
    assert [b.tolist() for b in model.books] == books
    assert {(r["c0"], r["whole"]) for r in got} == {(5, 6)}
    assert model.text() == ",".join(str(x) for b in books for e in b for x in e)


def test_few_rows_odd_dimension_and_empty_table(spark):
    rows = spark.createDataFrame([(1, [0.5] * 6, 1, "x", 1, 1), (2, [0.25] * 6, 1, "x", 1, 1)], SCHEMA)
    found, model = compress(rows)
    assert part_codes.part_borders(6, 4) == [0, 2, 4, 5, 6] and [len(b) for b in model.books] == [2] * 4
    assert {r["vec_id"]: (bytes(r["codes"]), r["error"]) for r in found.collect()} == {1: (bytes(4), 0), 2: (bytes([1] * 4), 0)}
    nothing, empty = compress(rows.where("vec_id > 5"))
    assert nothing.collect() == [] and empty.text() == ""


def test_query_on_the_given_table(spark):
    from callsift.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op11_vector_codes"](spark, folder).collect()
    table = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>"), "label").collect()
    wanted, books = plain([(r[0], r[1]) for r in table], 256, 4)
    assert sorted((r["vec_id"], bytes.fromhex(r["code"]), r["error"]) for r in rows) == wanted
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    assert {r["codebooks_sha256"] for r in rows} == {digest}
    label, total = {r[0]: r[2] for r in table}, {}
    for r in rows:
        total[label[r["vec_id"]]] = total.get(label[r["vec_id"]], 0) + r["error"]
    assert all(r["label_error"] == total[label[r["vec_id"]]] for r in rows)
