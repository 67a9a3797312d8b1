import json

import pytest
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.plans import curate, evaluate, generate, noise, pairs
from callsift.streaming import live


def write(path, records, blank=False):
    gap = "\n\n\n" if blank else "\n"
    path.write_text(gap.join(json.dumps(r, ensure_ascii=False) for r in records) + "\n", encoding="utf-8")
    return str(path)


def read(spark, path):
    return [json.loads(r.value) for r in spark.read.text(path).collect()]


def inputs(spark, folder):
    return {name: {r["input"] for r in read(spark, f"{folder}/split={name}")} for name in ("train", "validation", "test")}


# --- pairs ----------------------------------------------------------------------------------


def test_ten_documents_make_ten_pairs(spark, tmp_path):
    docs = [{"call_id": f"k{i}", "id": f"row {i}", "text": f"The {i}. caller asks when the shop opens"} for i in range(10)]
    gold = [{"id": f"k{i}", "label": "fine" if i % 3 else "fraud"} for i in range(10)]
    target = str(tmp_path / "sft")
    counts = pairs.run_prepare_pairs(spark, write(tmp_path / "d", docs), write(tmp_path / "g", gold), target)
    assert counts == {"total": 10, "matched": 10, "unmatched": 0, "train": 7, "validation": 1, "test": 2}
    first = read(spark, f"{target}/split=train")[0]
    assert set(first) == {"input", "output"} and first["output"] in ("fraud", "fine")


def test_missing_gold_stops_before_any_output(spark, tmp_path):
    docs = write(tmp_path / "d", [{"call_id": "k1", "text": "a call without gold"}])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        pairs.run_prepare_pairs(spark, docs, str(tmp_path / "none"), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_no_match_is_an_error(spark, tmp_path):
    docs = write(tmp_path / "d", [{"call_id": "a", "text": "a call without gold"}])
    gold = write(tmp_path / "g", [{"id": "b", "label": "fraud"}])
    with pytest.raises(ValueError):
        pairs.run_prepare_pairs(spark, docs, gold, str(tmp_path / "out"))


def test_no_leakage(spark, tmp_path):
    docs = [{"call_id": f"k{i}", "text": f"Order number {i * i} has arrived"} for i in range(20)]
    gold = [{"id": f"k{i}", "label": "fine"} for i in range(20)]
    target = str(tmp_path / "sft")
    counts = pairs.run_prepare_pairs(spark, write(tmp_path / "d", docs), write(tmp_path / "g", gold), target)
    assert (counts["train"], counts["validation"], counts["test"]) == (14, 3, 3)
    got = inputs(spark, target)
    assert not got["train"] & got["test"] and not got["train"] & got["validation"] and not got["validation"] & got["test"]


def test_blank_lines(spark, tmp_path):
    docs = write(tmp_path / "d", [{"call_id": "u", "text": "good morning"}, {"call_id": "v", "text": "good night"}], blank=True)
    gold = write(tmp_path / "g", [{"id": "u", "label": "fine"}, {"id": "v", "label": "fraud"}], blank=True)
    counts = pairs.run_prepare_pairs(spark, docs, gold, str(tmp_path / "sft"))
    assert counts["matched"] == 2 and (counts["train"], counts["validation"], counts["test"]) == (1, 0, 1)


# --- noise and curation ---------------------------------------------------------------------


def test_noise_then_curation(spark, tmp_path):
    flat = [{"call_id": f"doc-{i:05d}", "text": f"Kunde: Grüße {i}, ich hätte gern eine Auskunft über mein Konto, schönen Dank."} for i in range(300)]
    nested = [{"id": "n", "response": json.dumps({"transcript": [{"speaker": "Kunde", "text": "x" * 60}]})}, {"text": "y" * 60}, {"text": ""}]
    noisy = str(tmp_path / "noisy")
    stats = noise.run_noise(spark, write(tmp_path / "raw", flat + nested), noisy)
    assert sum(stats.values()) == 302 and set(stats) == {*V.NOISE_SHARES, "clean"}
    rows = read(spark, noisy)
    assert len(rows) == 302 + stats["duplicate"] and set(rows[0]) == {"call_id", "text", "is_clean", "noise_type"}
    assert {r["call_id"] for r in rows} >= {"n", "CALL_0301"}

    target = str(tmp_path / "curated")
    got = curate.run_curation(spark, noisy, target)
    assert got["rows_in"] == len(rows) and got["removed"] == stats["duplicate"] + stats["garbage"]
    kept = read(spark, target)
    assert len(kept) == got["kept"] and not any(r["noise_type"] == "garbage_text" for r in kept)
    assert len({r["id"] for r in kept}) == len(kept) and all(r["id"].startswith("FRAUD_data-") for r in kept)
    assert not any("Ã" in r["text"] or "4532-8921" in r["text"] for r in kept)
    pii = [r["text"] for r in kept if r["noise_type"] == "pii_injection"]
    assert pii and all("MASKIERT" in t or "Sozialversicherung" in t for t in pii)


def test_curation_gives_the_same_rows_in_any_partitioning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    one = sorted(map(tuple, curate.curate(docs.repartition(1), "doc_id").collect()))
    assert one == sorted(map(tuple, curate.curate(docs.repartition(8), "doc_id").collect()))


# --- evaluation -----------------------------------------------------------------------------


def fixed_answer(text):
    return lambda: lambda prompts: [text] * len(prompts)


def test_evaluate_logs_a_run_per_mode(spark, tmp_path):
    rows = spark.createDataFrame([("a", "fraud"), ("b", " Legitimate"), ("", "fraud")], "input string, output string")
    path = str(tmp_path / "metrics")
    got = {r["mode"]: r for r in evaluate.evaluate(rows, fixed_answer("Result: fraud"), path).collect()}
    assert set(got) == {"zero-shot", "few-shot"} and got["zero-shot"].accuracy == 0.5
    assert spark.read.parquet(path).groupBy("run").count().count() == 2


def test_failed_calls_count_in_the_match_rate_only(spark):
    def make():
        def ask(prompts):
            if any(p[-1]["content"] == "b" for p in prompts):
                raise RuntimeError("down")
            return ["Result: fraud"] * len(prompts)

        return ask

    rows = spark.createDataFrame([("a", "fraud"), ("b", "fraud")], "input string, output string")
    got = evaluate.evaluate(rows, make, modes=("zero-shot",)).first()
    assert (got.accuracy, got.match_rate_percentage) == (1.0, 50.0)


def test_judge_report(spark):
    rows = spark.createDataFrame([("x", "fraud"), ("y", "legitimate"), ("", "fraud")], "input string, output string")
    report = evaluate.judge(rows, fixed_answer(" Result: fraud\n ok "), fixed_answer("Score: PASS"), ["input"])
    got = sorted(map(tuple, report.drop("error").collect()))
    assert got == [(1, "fraud", "fraud", "PASS", "Result: fraud\n ok"), (2, "legitimate", "fraud", "PASS", "Result: fraud\n ok")]


def test_infer(spark):
    short, long_text = "please read me your card number", "and then we waited again, " * 4000
    rows = spark.createDataFrame([(short,), ("",), (" \n\t ",), (long_text,)], "text string")
    got = {r.text: r for r in evaluate.infer(rows, fixed_answer("Result: fraud")).collect()}
    assert got[short].label == "fraud" and got[short].confidence == 1.0
    assert got[""].error and got[""].label is None and got[" \n\t "].error
    assert got[long_text].prompt_length > len(long_text)


# --- generation -----------------------------------------------------------------------------


def test_generation_asks_again_until_accepted(spark):
    def make_writer():
        def ask(requests):
            for r in requests:
                assert 0.7 <= r["temperature"] <= 0.95 and r["max_tokens"] in (600, 1000, 1600)
            return [json.dumps({"text": f"t{r['temperature']}"}) for r in requests]

        return ask

    def make_judge():
        # A text is good when its temperature ends in an even digit, so that some samples need more attempts.
        return lambda prompts: [f'{{"score": {4 if int(p[0]["content"].split("Transkript: t")[1].split(chr(10))[0][-1]) % 2 == 0 else 3}}}' for p in prompts]

    plan = generate.plan_samples(spark.range(1, 61).withColumnRenamed("id", "number"))
    got = generate.generate(plan, make_writer, make_judge, "mine").collect()
    assert len({r.id for r in got}) == len(got) and {r.attempt for r in got} == {0, 1, 2} and {r.score for r in got} == {4}
    everything = generate.generate(plan, make_writer, make_judge, "mine", least=3).collect()
    assert len(everything) == 60 and {r.attempt for r in everything} == {0}


def test_generation_survives_failures(spark):
    def broken():
        def ask(_):
            raise RuntimeError("down")

        return ask

    plan = generate.plan_samples(spark.range(1, 4).withColumnRenamed("id", "number"))
    assert generate.generate(plan, broken, fixed_answer('{"score": 5}'), "mine").count() == 0
    assert generate.generate(plan, fixed_answer("Kunde: a"), broken, "mine").count() == 0


# --- streams --------------------------------------------------------------------------------


def test_stream_counter_over_arriving_files(spark, tmp_path):
    folder, table, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "label string"
    for labels in (["fraud", "legitimate", "fraud"], ["fraud"]):
        spark.createDataFrame([(x,) for x in labels], schema).write.mode("append").parquet(folder)
        live.stream_fraud_counter(live.arriving(spark, folder, schema), table, state).awaitTermination()
    assert {r.label: r.calls for r in spark.read.parquet(table).collect()} == {"fraud": 3, "legitimate": 1}


def test_stream_curation_equals_batch(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs.repartition(3).write.parquet(folder)
    live.stream_curate_rows(live.arriving(spark, folder, "doc_id long, text string"), out, state).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, curate.clean_rows(docs).collect()))


# --- command line ---------------------------------------------------------------------------


def test_jobs_from_the_command_line(spark, tmp_path):
    from callsift.__main__ import arguments, run

    raw = write(tmp_path / "raw", [{"call_id": f"c{i}", "text": f"Anruf {i} " + "x" * 60} for i in range(40)])
    gold = write(tmp_path / "gold", [{"id": f"c{i}", "label": "fraud" if i % 2 else "legitimate"} for i in range(40)])
    noisy, curated, target = (str(tmp_path / n) for n in ("noisy", "curated", "sft"))
    assert sum(run(spark, arguments(["noise", raw, noisy])).values()) == 40
    kept = run(spark, arguments(["curate", noisy, curated]))["kept"]
    counts = run(spark, arguments(["pairs", curated, gold, target, "--seed", "7"]))
    assert counts["total"] == kept and counts["train"] + counts["validation"] + counts["test"] == counts["matched"]
