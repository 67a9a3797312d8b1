"""Repeated substrings against brute force."""

import hashlib
import random

import pyarrow.parquet as pq
import pytest

from callsift.llm import repeats as R
from callsift.llm.queries import QUERIES


def brute(texts, length=100):
    """For (key, text) in order: bytes, removed bytes, runs and what is left."""
    seen, out = set(), []
    for _, text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            else:
                seen.add(window)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return out


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = sorted(pq.read_table(f"{folder}/documents.parquet").to_pandas()[["doc_id", "text"]].itertuples(index=False, name=None))
    got = {r["doc_id"]: r for r in QUERIES["op2_suffix_dedup"](spark, folder).collect()}
    assert len(got) == len(texts)
    for (name, _), (n, removed, spans, kept) in zip(texts, brute(texts)):
        r = got[name]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, removed, spans, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("bucket, hot", [(R.BUCKET, R.HOT), (300, R.HOT), (R.BUCKET, 50)])
def test_dense_repeats_by_either_way(spark, monkeypatch, bucket, hot):
    """Small alphabet, many overlaps, one text a period of one letter; small buckets, and hot hashes window by window."""
    monkeypatch.setattr(R.repeated_spans, "__defaults__", (R.LENGTH, bucket, hot))
    draw = random.Random(4)
    parts = ["".join(draw.choices("abé", k=draw.randint(3, 12))) for _ in range(12)]
    rows = [(i, "".join(draw.choices(parts, k=draw.randint(0, 30)))) for i in range(60)]
    rows += [(60, "z" * 400), (61, "z" * 90), (62, None), (63, ""), (64, rows[3][1])]
    got = {r["doc_id"]: r for r in R.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), length=20).collect()}
    for (name, _), wanted in zip(rows, brute(rows, 20)):
        assert tuple(got[name][x] for x in ("n_bytes", "n_removed", "n_spans", "kept")) == wanted


def test_repeated_rows_null_keys_and_other_columns(spark):
    text = "".join(random.Random(1).choices("abcdefgh ", k=300))
    rows = [(5, text, 1), (5, text, 1), (7, text, 2), (None, text, 3), (None, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int").withColumnRenamed("spans", "n_spans")
    got = sorted((r["doc_id"] or 99, r["n_removed"], r["n_spans"]) for r in R.remove_repeats(df).collect())
    assert got == [(5, 0, 0), (5, 0, 0), (7, 300, 1), (99, 0, 0), (99, 300, 1)]
    assert R.remove_repeats(df.limit(0)).count() == 0


def test_merged_transform_orders_suffixes():
    draw = random.Random(9)
    strings = [bytes(draw.choices(b"ab", k=draw.randint(1, 15))) for _ in range(40)]
    for shard in (10_000, 60, 1):
        got = R.later_windows(strings, 4, shard)
        seen, wanted = set(), []
        for s in strings:
            starts = []
            for i in range(len(s) - 3):
                if s[i : i + 4] in seen:
                    starts.append(i)
                seen.add(s[i : i + 4])
            wanted.append(starts)
        assert [x.tolist() for x in got] == wanted


def test_texts_of_one_id_are_told_apart_exactly(spark):
    """Two texts under null ids with one 32-bit hash: neither gets the other's spans."""
    from pyspark.sql import functions as F

    body = "".join(random.Random(2).choices("abcdefgh ", k=330))
    made = spark.range(200_000).select(F.concat(F.lit(body), F.col("id").cast("string")).alias("t"))
    one, two = made.groupBy(F.hash("t")).agg(F.sort_array(F.collect_list("t")).alias("t")).where(F.size("t") > 1).orderBy(F.col("t")[0]).first()["t"][:2]
    other = "".join(random.Random(3).choices("ijklmnop ", k=338))
    for texts in ([one, two], [two, other], [other, one]):
        rows = [(1, texts[0]), (None, texts[0]), (None, texts[1])]
        got = {r["text"]: r for r in R.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id IS NULL").collect()}
        late = sorted(texts, key=lambda t: hashlib.sha256(t.encode()).hexdigest())
        for text, wanted in zip(late, brute([(1, texts[0])] + [(2, t) for t in late])[1:]):
            assert (got[text]["n_bytes"], got[text]["n_removed"], got[text]["n_spans"], bytes(got[text]["kept"])) == wanted


def test_columns_named_like_internal_ones_pass(spark):
    text = "".join(random.Random(1).choices("abcdefgh ", k=200))
    names = ["_doc", "_key", "_spans", "doc", "key", "spans", "c0", "hash", "digest", "count"]
    df = spark.createDataFrame([(i, text, *range(10)) for i in (3, 4, 4)], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    rows = R.remove_repeats(df).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in rows) == [(3, 0), (4, 200), (4, 200)]
    assert all([r[n] for n in names] == list(range(10)) for r in rows)
