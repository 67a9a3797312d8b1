"""Records by spans, and answers in JSON of any length."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from callsift.functions.answers import clean_answer, judge_score, unwrap_chat, unwrap_completion, unwrap_guarded
from callsift.functions.records import record_line, record_spans, record_text, spans_of
from callsift.operators.ids import add_id, number_by_position
from callsift.plans.curate import run_curation
from callsift.sources.jsonl import read_jsonl_lenient, read_jsonl_plain, read_jsonl_strict

LONG = "Ein langer Text über Äpfel und Birnen, der lang genug ist. "
VALUES = st.recursive(st.none() | st.booleans() | st.integers() | st.floats() | st.text(max_size=6), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=3), x, max_size=3), max_leaves=6)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "text", 'q"\\', "ü"]), VALUES), max_size=5), st.booleans(), st.sampled_from(["", " ", "\t"]))
def test_spans_hold_what_the_parser_reads(items, plain, gap):
    line = "{" + ",".join(f"{gap}{json.dumps(k, ensure_ascii=plain)}{gap}:{gap}{json.dumps(v, ensure_ascii=plain)}{gap}" for k, v in items) + "}"
    wanted = json.loads(line)
    found = spans_of(line)
    assert [s[0] for s in found] == list(wanted)
    for key, kind, start, size in found:
        value, kinds = wanted[key], {str: "string", dict: "object", list: "array", bool: "boolean", type(None): "null"}
        assert kind == kinds.get(type(value), "number")
        assert json.dumps(json.loads(line[start : start + size])) == json.dumps(value)


@pytest.mark.parametrize("line", [None, "", "[1]", "5", '{"a":1', '{"a" 1}', '{"a":1,}', '{"a":1}x', "{a:1}", '{"a":}', '{"a":1 "b":2}', '{"a', "{", '{"a":' + "[" * 100_000 + "}"])
def test_what_is_no_object_has_no_spans(line):
    assert spans_of(line) is None


def test_records_keep_kind_spelling_and_the_last_value(spark):
    lines = ['{"text":"a\\u00e4","k":1,"x":"5","text":"b\\n\\"","k":2}', '{"n":1.10,"m":NaN,"i":1e400,"big":' + "7" * 1200 + ',"f":{"z":-Infinity,"k":1,"k":2},"text":null}', '{"text":7,"e":[1, "x"]}', "{}"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string").withColumn("spans", record_spans("line"))
    text = record_text(F.col("line"), F.col("spans"), "text")
    shown = record_line(F.col("line"), F.col("spans"), {"text": F.lit("neu"), "id": F.lit(None).cast("string")})
    got = df.select("i", text.alias("t"), shown.alias("l")).orderBy("i").collect()
    assert [r["t"] for r in got] == ['b\n"', None, "7", None]
    assert got[0]["l"] == '{"text":"neu","id":null,"k":2,"x":"5"}'
    assert got[1]["l"] == '{"text":"neu","id":null,"n":1.10,"m":NaN,"i":1e400,"big":' + "7" * 1200 + ',"f":{"z":-Infinity,"k":1,"k":2}}'
    assert got[2]["l"] == '{"text":"neu","id":null,"e":[1, "x"]}' and got[3]["l"] == '{"text":"neu","id":null}'


def test_curation_and_readers_take_the_same_value_at_any_length(spark, tmp_path):
    path = tmp_path / "in.json"
    huge = "x" * 21_000_000
    lines = [f'{{"text":"old {LONG}","text":"new {LONG}","k":1,"k":2}}', f'{{"text":"{LONG}1","s":"5","d":NaN}}', f'{{"text":"{LONG}2","s":"5","big":"{huge}"}}', json.dumps({"text": LONG * 400_000}, ensure_ascii=False)]
    path.write_text("\n".join(lines), encoding="utf-8")
    assert run_curation(spark, str(path), str(tmp_path / "out"))["kept"] == 4
    got = {line[:60]: line for (line,) in spark.read.text(str(tmp_path / "out")).collect()}
    assert all('"text":"old' not in line and line.count('"k"') <= 1 for line in got.values())
    assert sum('"s":"5","d":NaN}' in line for line in got.values()) == 1 and sum(len(line) > 21_000_000 for line in got.values()) == 2
    wanted = sorted([len(f"new {LONG}"), len(LONG) + 1, len(LONG) + 1, len(LONG) * 400_000])
    for rows in (read_jsonl_plain(spark, str(path)), read_jsonl_strict(spark, str(path))[0], read_jsonl_lenient(spark, str(path))[0]):
        assert sorted(r[0] for r in rows.select(F.length("text")).collect()) == wanted
        assert rows.where(F.startswith("text", F.lit("old"))).isEmpty()


def test_long_answers_are_read_like_short_ones(spark):
    def rows(n):
        word = "y" * n
        return [f'{{"choices":[{{"message":{{"content":" {word} "}},"text":"{word}"}}]}}', f'{{"text":"{word}","k":NaN}}', f'{{"content":"{word}","content":"{word}z"}}', f'{{"score":"4","why":"{word}"}}', f'{{"text":["{word}"]}}', f'{{"other":"{word}"}}']

    def lengths(n):
        df = spark.createDataFrame([(i, r) for i, r in enumerate(rows(n))], "i int, raw string").repartition(6)
        raw = F.col("raw")
        shown = [F.length(unwrap_chat(raw)), F.length(unwrap_completion(raw)), F.length(unwrap_guarded(raw)), F.length(clean_answer(raw)), judge_score(raw)]
        return [tuple(r)[1:] for r in df.select("i", *[c.alias(f"c{j}") for j, c in enumerate(shown)]).orderBy("i").collect()]

    short, n = lengths(10), 21_000_000
    sizes = [len(r) for r in rows(10)]
    assert short == [(10, 10, sizes[0], sizes[0], 0), (None, None, sizes[1], 10, 0), (None, None, 11, sizes[2], 0), (None, None, sizes[3], sizes[3], 4), (None, None, sizes[4], None, 0), (None, None, sizes[5], sizes[5], 0)]
    more, two = n - 10, {(0, 2), (0, 3), (2, 3)}  # raw answers that hold the word twice
    long = lengths(n)
    grown = [tuple(x if x is None or j == 4 else x + more * (2 if (i, j) in two else 1) for j, x in enumerate(row)) for i, row in enumerate(short)]
    assert long == grown


def test_parquet_rows_are_numbered_without_being_written(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(1000).select("id", F.repeat(F.lit("text "), 50).alias("text")).repartitionByRange(7, "id").sortWithinPartitions("id").write.option("parquet.block.size", 4096).parquet(path)
    numbered = number_by_position(spark.read.parquet(path), start=5)
    assert sorted((r["id"], r["row_id"]) for r in numbered.select("id", "row_id").collect()) == [(i, i + 5) for i in range(1000)]
    assert "text" not in numbered.select("id", "row_id")._jdf.queryExecution().executedPlan().toString()
    ids = add_id(spark.read.parquet(path)).select("text", "id")
    assert "positions-" not in ids._jdf.queryExecution().optimizedPlan().toString() and ids.distinct().count() == 1000
    gaps = number_by_position(spark.read.parquet(path).where("id % 3 = 0")).select("id", "row_id")
    assert sorted(tuple(r) for r in gaps.collect()) == [(3 * i, i) for i in range(334)]
    assert number_by_position(spark.read.parquet(path).where("id < 0")).collect() == []
