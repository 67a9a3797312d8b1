import json

import pytest
from pyspark.sql import functions as F

from callsift.sources import jsonl, reports


def write(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_lenient(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", ['{"call_id": "a", "text": "ä"}', "", "   ", "{broken", '{"id": "b", "response": "{}"} x', '{"id": "c"}'])
    good, bad = jsonl.read_jsonl_lenient(spark, path)
    assert [(r.call_id, r.id, r.text) for r in good.collect()] == [("a", None, "ä"), (None, "c", None)]
    assert [r.value for r in bad.collect()] == ["{broken", '{"id": "b", "response": "{}"} x']
    assert bad.first().file_path.endswith("a.jsonl")


def test_lenient_missing_path_is_empty(spark, tmp_path):
    good, bad = jsonl.read_jsonl_lenient(spark, str(tmp_path / "none.jsonl"))
    assert good.count() == bad.count() == 0


def test_strict(spark, tmp_path):
    rows, found = jsonl.read_jsonl_strict(spark, write(tmp_path / "a", ['{"text": "x"}', "", '{"text": null}']))
    assert found == 2 and [r.text for r in rows.collect()] == ["x", None]
    for name, lines in {"key": ['{"text": "x"}', '{"body": "x"}'], "json": ['{"text": "x"', "{}"], "empty": ["", " "]}.items():
        with pytest.raises(ValueError):
            jsonl.read_jsonl_strict(spark, write(tmp_path / name, lines))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jsonl.read_jsonl_strict(spark, str(tmp_path / "missing"))


def test_plain_keeps_order_and_fails_on_bad_json(spark, tmp_path):
    path = write(tmp_path / "a", ['{"id": "1"}', "", '{"id": "2"}'])
    rows = jsonl.read_jsonl_plain(spark, path, jsonl.GOLD, with_order=True).orderBy("file_path", "position")
    assert [r.id for r in rows.collect()] == ["1", "2"]
    with pytest.raises(Exception, match="no JSON"):
        jsonl.read_jsonl_plain(spark, write(tmp_path / "b", ['{"id": "1"}', "nope"])).collect()


def test_documents_have_their_file_name(spark, tmp_path):
    write(tmp_path / "one.jsonl", ['{"text": "x", "noise_type": "none"}'])
    row = jsonl.read_documents(spark, str(tmp_path)).first()
    assert (row.text, row.file_name, row.call_id) == ("x", "one.jsonl", None)


def test_written_lines_keep_nulls_and_umlauts(spark, tmp_path):
    path = str(tmp_path / "out")
    frame = spark.createDataFrame([("a", None), ("ü\n", "x")], "text string, label string").coalesce(1)
    jsonl.write_jsonl(frame, path)
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert lines == [{"text": "a", "label": None}, {"text": "ü\n", "label": "x"}]
    assert any("ü" in r.value for r in spark.read.text(path).collect())
    jsonl.write_curated(frame.limit(1), path)
    assert spark.read.text(path).count() == 1


def test_pair_sink_appends(spark, tmp_path):
    frame = spark.createDataFrame([("doc-00001", "t", "fraud", 5)], "id string, text string, label string, score int")
    texts, gold = str(tmp_path / "t"), str(tmp_path / "g")
    for _ in range(2):
        reports.append_pair_sink(frame, texts, gold, "mine")
    assert [tuple(r) for r in spark.read.schema("id string, text string, source string").json(texts).distinct().collect()] == [("doc-00001", "t", "mine")]
    assert spark.read.text(gold).count() == 2


def test_report_csv(spark, tmp_path):
    frame = spark.createDataFrame([(1, "fraud", "fraud", "PASS", 'a "b",\nc')], "id long, true_label string, model_prediction string, judge_score string, model_output string")
    reports.write_report_csv(frame, str(tmp_path / "r"))
    row = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "r")).first()
    assert tuple(row) == ("1", "fraud", "fraud", "PASS", 'a "b", c')


def test_metrics_log(spark, tmp_path):
    path = str(tmp_path / "m")
    frame = spark.createDataFrame([(0.5, 0.25)], "accuracy double, weighted_f1 double")
    reports.log_run_metrics(frame, "run-1", {"model_name": "m", "dataset_file": "f"}, path)
    reports.log_run_metrics(frame, "run-2", {}, path)
    got = spark.read.parquet(path).orderBy("run", "metric")
    assert [(r.run, r.metric, r.value) for r in got.collect()][:2] == [("run-1", "accuracy", 0.5), ("run-1", "weighted_f1", 0.25)]
    assert got.where(F.col("run") == "run-1").first().params == {"model_name": "m", "dataset_file": "f"}
