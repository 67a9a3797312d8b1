"""Best-fit packing: bounds, search and pieces against the optimum of small cases and the tokenizers library."""

import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from callsift.llm import bin_completion
from callsift.llm.bin_completion import best_fit, complete_bins, dominated, fillings, least_bins, pack_best
from callsift.llm.bpe import vocabulary
from callsift.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def optimum(items, capacity):
    items, best = sorted(items, reverse=True), len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for room in {b for b in bins if b >= items[i]}:
            at = bins.index(room)
            place(i + 1, [*bins[:at], room - items[i], *bins[at + 1 :]])
        place(i + 1, [*bins, capacity - items[i]])

    place(0, [])
    return best


def histogram(items, capacity):
    return np.bincount(items, minlength=capacity + 1) if items else np.zeros(capacity + 1, np.int64)


def check_bins(bins, counts):
    held = np.zeros_like(counts)
    for times, filling in bins:
        assert times > 0 and sum(a * n for a, n in filling) < len(counts)
        for a, n in filling:
            held[a] += times * n
    assert (held == counts).all()
    return sum(times for times, _ in bins)


def test_small_cases_are_optimal():
    draw, best_fit_worse = random.Random(5), 0
    for _ in range(400):
        capacity, n = draw.choice([10, 20, 37, 100]), draw.randint(0, 12)
        items = [draw.randint(1, capacity) if draw.random() < 0.4 else draw.randint(max(1, capacity // 4), capacity // 2) for _ in range(n)]
        counts, least = histogram(items, capacity), optimum(items, capacity)
        assert least_bins(counts) <= least == check_bins(complete_bins(counts), counts)
        best_fit_worse += check_bins(best_fit(counts), counts) > least
    assert best_fit_worse  # the search has something to do


@pytest.mark.parametrize("low,high,n,gain", [(700, 1500, 3000, 15), (20, 100, 500, 0), (1500, 4000, 3000, 0)])
def test_search_is_no_worse_than_best_fit(low, high, n, gain):
    draw = random.Random(low)
    counts = histogram([draw.randint(low, high) for _ in range(n)], 4096)
    first, found = check_bins(best_fit(counts), counts), check_bins(complete_bins(counts), counts)
    assert least_bins(counts) <= found <= first - gain


def test_a_third_of_all_items_of_one_length():
    draw = random.Random(8)
    counts = histogram([draw.randint(1, 1200) for _ in range(20_000)], 4096)
    counts[777] += 10_000
    counts[4096] = 1_000_000
    assert check_bins(complete_bins(counts * 1000), counts * 1000) <= least_bins(counts * 1000) * 1.001


def test_fillings_are_undominated_and_in_order_of_waste():
    counts = histogram([7, 5, 4, 3, 2], 10)
    found = list(fillings(counts, 9, 9, [0]))
    assert [w for w, _ in found] == sorted(w for w, _ in found)
    assert (0, ((7, 1), (2, 1))) in found and (0, ((5, 1), (4, 1))) in found
    assert (0, ((4, 1), (3, 1), (2, 1))) not in found  # 3 and 2 give way to 5
    assert dominated(((4, 1), (3, 1), (2, 1)), 0, counts) and not dominated(((7, 1), (2, 1)), 0, counts)


def check_pieces(rows, wanted, length):
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert docs.keys() == wanted.keys()
    for name, ids in wanted.items():
        at = 0
        for i, r in enumerate(sorted(docs[name], key=lambda r: r["start"])):
            size = min(length, len(ids) - at)
            assert (r["piece"], r["start"], r["length"], r["doc_tokens"]) == (i, at, size, len(ids))
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + size], "<u4").tobytes())
            at += size
        assert at == len(ids)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length
    return len(sequences)


def test_query_like_the_library(spark):
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    table = pq.read_table(f"{FOLDER}/documents.parquet")
    wanted = {n: [*library.encode(t or "", add_special_tokens=False).ids, 1] for n, t in zip(table["doc_id"].to_pylist(), table["text"].to_pylist())}
    found = check_pieces(QUERIES["op13_best_fit"](spark, FOLDER).collect(), wanted, 4096)
    items = [len(ids) % 4096 for ids in wanted.values() if len(ids) % 4096] + [4096] * sum(len(ids) // 4096 for ids in wanted.values())
    assert found == least_bins(histogram(items, 4096))


def test_odd_rows_many_partitions_and_empty_table(spark):
    from pyspark.sql import functions as F

    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    draw = random.Random(3)
    texts = {i: " ".join(draw.choices(["the", "cat", "sat", "1234", "İstanbul", "日本"], k=draw.choice([0, 1, 5, 40, 300]))) for i in range(300)}
    texts |= {400: None, 401: "", 402: "word " * 5000, None: "no key"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("rest", F.lit(1)).repartition(23)
    rows = pack_best(df, length=128).withColumn("ids_crc32", F.crc32("ids"))
    wanted = {n: [*library.encode(t or "", add_special_tokens=False).ids, 1] for n, t in texts.items()}
    sequences = check_pieces(rows.collect(), wanted, 128)
    items = [x for ids in wanted.values() for x in [128] * (len(ids) // 128) + [len(ids) % 128] if x]
    counts = histogram(items, 128)
    assert least_bins(counts) <= sequences <= check_bins(best_fit(counts), counts)
    twice = pack_best(df.unionByName(df).where("doc_id = 5"), length=128).collect()
    assert sum(r["length"] for r in twice) == 2 * len(wanted[5])
    assert pack_best(df.where("doc_id = -1")).collect() == []
    assert bin_completion.complete_bins(np.zeros(11, np.int64)) == []
