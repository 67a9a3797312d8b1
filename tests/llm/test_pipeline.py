"""Each stage of the pipeline against a plain version on its own input, then run() as their chain."""

import gc
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline as P
from callsift.llm import base, language_id, quality_rules
from callsift.llm.bpe import codec, vocabulary
from callsift.llm.packing import pack
from callsift.llm.piece_codec import PieceCodec
from callsift.llm.simhash import fingerprint
from tests.llm.test_repeats import brute

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return sorted((tuple(r[c] for c in P.COLUMNS) for r in df.collect()), key=repr)


def components(prints, radius=3):
    part = list(range(len(prints)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    values = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= radius) + i + 1:
            a, b = find(i), find(int(j))
            part[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def plain_line(line):
    """Lower case, one space between words, runs of digits as 0; without the operator's helpers."""
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", line) if w]
    return re.sub("[0-9]+", "0", " ".join("".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words))


def count_words(text):
    return len(re.findall("[^ \t\n\x0b\x0c\r]+", text))


def expected_quality(rows):
    holders = {}
    for _, text, _, source, _ in rows:
        lines = [x for x in map(plain_line, (text or "").split("\n")) if x]
        for line in lines:
            holders.setdefault((source, line), set()).add("\n".join(lines))
    bad = {k for k, v in holders.items() if len(v) > 20}
    out = []
    for name, text, lang, source, _ in rows:
        words = re.findall("[^ \t\n\x0b\x0c\r]+", text or "")
        windows = Counter(zip(words, words[1:], words[2:]))
        again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
        left = [x for x in (text or "").split("\n") if (source, plain_line(x)) not in bad]
        gone = len(words) - count_words("\n".join(left))
        if len(words) >= 50 and 100 * len(again) <= 50 * len(words) and 100 * gone <= 50 * len(words):
            clean = "\n".join(left) if gone else text
            out.append((name, clean, lang, source, len(clean)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def stages(spark):
    docs, found = P.table(spark, FOLDER, "documents"), []
    for _, stage in P.STAGES:
        docs = stage(spark, docs, FOLDER)
        found.append(docs)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    return [P.table(spark, FOLDER, "documents"), *found]


def test_stages_one_after_the_other(spark, stages):
    given = [rows_of(x) for x in stages[:5]]
    assert given[1] == expected_quality(given[0])
    assert given[2] == [r for r in given[1] if any(map(str.isalpha, r[1]))]
    part = components([fingerprint(r[1]) for r in sorted(given[2], key=lambda r: r[0])])
    ordered = sorted(given[2], key=lambda r: r[0])
    assert given[3] == sorted((ordered[i] for i in sorted(set(part))), key=repr)
    ordered = sorted(given[3], key=lambda r: r[0])
    cut = [(r, kept.decode("utf-8", "ignore")) for r, (_, _, _, kept) in zip(ordered, brute([(r[0], r[1]) for r in ordered]))]
    assert given[4] == sorted(((r[0], t, r[2], r[3], len(t)) for r, t in cut if t.strip(" ")), key=repr)
    check_pieces(stages[5].collect(), given[4])


def check_pieces(pieces, rows):
    ids = {r[0]: codec(vocabulary()).encode(r[1]) + np.array([1], "<u4").tobytes() for r in rows}
    found, places = {}, []
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        assert len(found.get(p["doc_id"], b"")) == 4 * p["start"] and p["ids_crc32"] == zlib.crc32(bytes(p["ids"]))
        found[p["doc_id"]] = found.get(p["doc_id"], b"") + bytes(p["ids"])
        places.append((p["sequence_id"] * 2048 + p["offset"], p["length"]))
    assert found == ids
    places.sort()
    assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and places[0][0] == 0


def test_run_is_the_chain(spark, stages):
    wanted = sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in stages[5].collect())
    got = [(r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in P.run(spark, FOLDER).collect()]
    assert sum(n for _, _, n, _ in got) == sum(r["length"] for r in stages[5].collect())
    assert {x[0] for x in got} == {x[0] for x in wanted}


def test_odd_rows(spark):
    long = "word one two three four five six seven eight nine ten " * 3
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "12 34 " * 40, "en", "a", 240), (3, long, None, None, 5), (3, long, None, None, 5)]
    rows += [(9 + i, " ".join(f"the{i}w{j} and of" for j in range(40)), "en", "a", 1) for i in range(3)]
    rows += [(20, " ".join(f"der{j} und die" for j in range(40)), "de", "b", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, df, FOLDER).columns == P.COLUMNS
        assert stage(spark, df.limit(0), FOLDER).count() == 0
        stage(spark, df, FOLDER).count()
    assert sum(r["length"] for r in P.STAGES[-1][1](spark, df, FOLDER).collect()) > len(rows)
    assert sorted(r["doc_id"] for r in P.simhash(spark, df, FOLDER).where("doc_id >= 3").collect()) == [3, 9, 10, 11, 20]


def test_a_worker_holds_little(spark, monkeypatch):
    """Stages make their rows a few at a time, and a worker drops the token tables when another step begins."""
    docs = spark.createDataFrame([(i, f"Line {i} of a text", "en", "web", 10) for i in range(1200)], SCHEMA).repartition(8)
    made, real = [], base.map_columns

    def watched(df, make, schema):
        made.append((make, df.columns))
        return real(df, make, schema)

    monkeypatch.setattr(quality_rules, "map_columns", watched)
    monkeypatch.setattr(language_id, "map_columns", watched)
    quality_rules.apply_quality_rules(docs)
    language_id.predict(docs, language_id.Model([], np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0)))
    assert len(made) == 3
    values = {"text": pa.array(["a line"] * 1200), "c1": pa.array(["a line"] * 1200), "host": pa.array(["web"] * 1200), "lines": pa.nulls(1200, pa.list_(pa.int64()))}
    for make, names in made:
        parts = list(make()({x: values.get(x, pa.array(range(1200))) for x in names}))
        assert len(parts) > 1 and max(len(next(iter(p.values()))) for p in parts) <= 500
        assert sum(len(next(iter(p.values()))) for p in parts) == 1200

    def tables():
        def work(columns):
            gc.unfreeze()
            return {"n": [sum(isinstance(x, PieceCodec) for x in gc.get_objects())]}

        return work

    assert pack(docs).count() >= 1200
    assert base.map_columns(docs.select("doc_id"), tables, "n int").agg({"n": "max"}).first()[0] == 0
