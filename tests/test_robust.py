"""Cases that once lost data, gave wrong numbers or stopped a job."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from callsift.functions import jsontext
from callsift.functions import text as tx
from callsift.operators import ids, splits
from callsift.plans.curate import run_curation
from callsift.plans.pairs import run_prepare_pairs
from callsift.session import shared_folder
from callsift.sources import jsonl, reports

REPO = Path(__file__).resolve().parent.parent


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(x + "\n" for x in lines), encoding="utf-8")
    return str(path)


def read(folder):
    rows = [json.loads(x) for p in sorted(Path(folder).glob("part-*")) for x in p.read_text(encoding="utf-8").splitlines()]
    return sorted(rows, key=lambda r: r["id"])


@pytest.fixture
def changed_splits(spark):
    """Other split settings when a result is asked for than when it was planned."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {n: spark.conf.get(n) for n in names}

    def change(size):
        for n in names:
            spark.conf.set(n, size)

    yield change
    for n, value in old.items():
        spark.conf.set(n, value)


@pytest.mark.parametrize("first, then", [("1k", "100m"), ("100m", "1k")])
def test_numbers_do_not_hang_on_splits(spark, tmp_path, changed_splits, first, then):
    for i, rows in enumerate((3, 400, 50, 1)):
        write(tmp_path / f"f{i}.jsonl", [f"{i}:{k:04d}" for k in range(rows)])
    changed_splits(first)
    got = ids.number_by_position(spark.read.text(str(tmp_path)), start=5)
    changed_splits(then)
    rows = sorted((r.row_id, r.value) for r in got.collect())
    assert rows == [(5 + n, v) for n, v in enumerate(f"{i}:{k:04d}" for i, m in enumerate((3, 400, 50, 1)) for k in range(m))]


def test_first_copy_is_that_of_the_first_file_in_a_folder_named_exchange(spark, tmp_path):
    source = tmp_path / "StockExchange"
    said = "The same words in two files, long enough to be kept in the end."
    write(source / "a.jsonl", [json.dumps({"text": said, "who": "a"}), "", json.dumps({"text": f"x {said}"})])
    write(source / "b.jsonl", [json.dumps({"text": f"{k} {said}"}) for k in range(50)] + [json.dumps({"text": said, "who": "b"})])
    found = run_curation(spark, str(source), str(tmp_path / "out"))
    rows = read(tmp_path / "out")
    assert found["rows_in"] == 53 and found["kept"] == len(rows) == 52
    assert rows[0]["who"] == "a" and rows[0]["id"].endswith("-0000000000") and rows[0]["file_name"] == "a.jsonl"
    assert [r["text"][0] for r in rows[2:12]] == list("0123456789")


def test_records_keep_all_fields_and_long_texts(spark, tmp_path):
    long = "long words " * 2_000_000
    rows = [
        {"id": "own", "text": "first text " * 9, "source": "generator", "n": 7, "empty": None, "deep": {"a": [1, {"b": "ü"}]}},
        {"text": long, "call_id": None},
        {"text": "third text " * 9, "is_clean": True},
    ]
    source = write(tmp_path / "in.jsonl", [json.dumps(r, ensure_ascii=False) for r in rows])
    run_curation(spark, source, str(tmp_path / "out"))
    got = read(tmp_path / "out")
    for r, mine in zip(rows, got):
        assert mine.pop("file_name") == "in.jsonl" and mine.pop("id").startswith("FRAUD_data-")
        r.pop("id", None)
        assert mine == r


def test_json_is_judged_as_a_whole(spark):
    texts = ['{"text":1} junk', '{"text":NaN}', f'{{"text":"{"x" * 21_000_000}"}}', "1" * 1201, "1,2", '1],[2', "{'a':1}", '{"text":null}', "[1]"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: (r.j, r.k) for r in df.select("i", jsontext.is_json(F.col("t")).alias("j"), jsontext.has_key(F.col("t"), "text").alias("k")).collect()}
    assert [got[i][0] for i in range(9)] == [False, True, True, True, False, False, False, True, True]
    assert [got[i][1] for i in range(9)] == [False, True, True, False, False, False, False, True, False]
    turns = '{"transcript":[{"speaker":"A","text":"hi"}]}'
    flat = spark.createDataFrame([(None, turns), (None, turns + " x")], "t string, r string")
    assert [r.f for r in flat.select(tx.flatten_transcript(F.col("t"), F.col("r")).alias("f")).collect()] == ["A: hi", ""]


def test_lenient_reader_numbers_bad_lines_and_skips_numeric_texts(spark, tmp_path):
    path = write(tmp_path / "x.jsonl", ['{"text": 5, "response": "r"}', "", "bad", '{"text": "5"}', '{"a": 1} tail'])
    good, _ = jsonl.read_jsonl_lenient(spark, path)
    assert sorted((r.text or "", r.response or "") for r in good.collect()) == [("", "r"), ("5", "")]
    assert sorted((r.line, r.value) for r in jsonl.bad_lines(spark, path).collect()) == [(3, "bad"), (5, '{"a": 1} tail')]
    with pytest.raises(Exception):
        jsonl.read_documents(spark, path).collect()


def test_keys_that_read_alike_are_told_apart(spark):
    rows = [("a", None, i) for i in range(1)] + [(None, "a", 1), ("a:b", "c", 2), ("a", "b:c", 3), ("", "a", 4), ("a", "", 5)]
    df = spark.createDataFrame(rows, "x string, y string, n int")
    assert df.select(splits.split_digest(42, ["x", "y"])).distinct().count() == 6
    for copies in (1, 7):
        many = df.crossJoin(spark.range(copies)).drop("id")
        sizes = {r.split: r.rows for r in splits.split_sizes(splits.seeded_split_exact(many, ["x", "y"])).collect()}
        end, more = splits.split_sizes_for(6 * copies)
        assert (sizes.get("train", 0), sizes.get("validation", 0)) == (end, more - end)


def test_pairs_read_their_sources_once(spark, tmp_path):
    docs = write(tmp_path / "d.jsonl", [json.dumps({"id": f"i{k}", "text": f"text {k}: with (signs)"}) for k in range(40)])
    gold = write(tmp_path / "g.jsonl", [json.dumps({"id": f"i{k}", "ground_truth": "fraud" if k % 2 else "legitimate"}) for k in range(40)])
    before = set(os.listdir(shared_folder(spark).removeprefix('file:')))
    found = run_prepare_pairs(spark, docs, gold, str(tmp_path / "out"))
    assert set(os.listdir(shared_folder(spark).removeprefix('file:'))) == before
    assert found["matched"] == 40 and (found["train"], found["validation"], found["test"]) == (28, 6, 6)


def test_a_run_is_logged_once(spark, tmp_path):
    path = str(tmp_path / "metrics")
    one = spark.createDataFrame([(0.5, 2)], "accuracy double, rows int")
    for run in ("a", "b", "a"):
        reports.log_run_metrics(one, run, {"model_name": "m"}, path)
    assert spark.read.parquet(path).count() == 4


def test_csv_keeps_outer_blanks(spark, tmp_path):
    rows = spark.createDataFrame([(1, " a", "b ", "PASS", "  c\td ")], "id long, true_label string, model_prediction string, judge_score string, model_output string")
    reports.write_report_csv(rows, str(tmp_path / "r"))
    assert "1, a,b ,PASS,  c\td \n" in "".join(p.read_text() for p in (tmp_path / "r").glob("part-*"))


def test_repair_of_the_other_lead_character(spark):
    df = spark.createDataFrame([("20 Â°C, 5 Â£, StraÃŸe, Â alone, Ã",)], "t string")
    assert df.select(tx.repair_unicode(F.col("t"))).first()[0] == "20 °C, 5 £, Straße, Â alone, Ã"


def test_a_job_runs_from_another_folder(tmp_path):
    source = write(tmp_path / "in.jsonl", [json.dumps({"text": "some words that are long enough to be kept " * 3})])
    (tmp_path / "own.py").write_text("def make():\n    return lambda prompts: ['Result: fraud' for _ in prompts]\n")
    env = os.environ | {"PYTHONPATH": f"{REPO}:{tmp_path}"}
    run = lambda *a: subprocess.run([sys.executable, "-m", "callsift", *a], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    found = run("infer", source, str(tmp_path / "answers"), "--model", "own:make")
    assert found.returncode == 0, found.stderr[-2000:]
    assert [json.loads(x)["label"] for p in (tmp_path / "answers").glob("part-*") for x in p.read_text().splitlines()] == ["fraud"]
