"""What a crash leaves behind: published folders, paired sinks, the ledger of answers."""

import os
from collections import Counter
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from callsift.operators.ledger import known_answers, read_ledger
from callsift.operators.scoring import score_with
from callsift.plans.curate import run_curation
from callsift.plans.noise import run_noise
from callsift.sources import jsonl, publish, reports
from callsift.sources.paired import PairedSink
from callsift.sources.publish import Folder

LONG = "Guten Tag, hier spricht die Bank, es geht um Ihr Konto. "


def contents(spark, path):
    return sorted(r[0] for r in spark.read.text(str(path)).collect())


def fails(spark):
    """Rows of which some can be written before one fails."""
    return spark.range(4, numPartitions=4).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("long")).alias("id"))


def test_a_failing_run_leaves_the_old_data(spark, tmp_path):
    target = str(tmp_path / "out")
    jsonl.write_curated(spark.range(3).select("id"), target)
    old = contents(spark, target)
    with pytest.raises(PySparkException):
        jsonl.write_curated(fails(spark), target)
    assert contents(spark, target) == old and os.listdir(tmp_path) == ["out"]
    jsonl.write_curated(spark.range(9, 10).select("id"), target)
    assert contents(spark, target) == ['{"id":9}'] and os.listdir(tmp_path) == ["out"]


def test_a_failing_first_run_leaves_nothing(spark, tmp_path):
    with pytest.raises(PySparkException):
        jsonl.write_curated(fails(spark), str(tmp_path / "out"))
    assert os.listdir(tmp_path) == []


def test_the_old_data_may_be_read_for_the_new(spark, tmp_path):
    target = str(tmp_path / "out")
    jsonl.write_curated(spark.range(3).select("id"), target)
    jsonl.write_curated(spark.read.schema("id long").json(target).select((F.col("id") + 1).alias("id")), target)
    assert contents(spark, target) == ['{"id":1}', '{"id":2}', '{"id":3}']


@pytest.mark.parametrize("moves", [0, 1, 2])
def test_a_complete_run_is_finished_by_the_next(spark, tmp_path, monkeypatch, moves):
    """The run dies before it steps in, between the two renames, or before the old folder is deleted."""
    target = str(tmp_path / "out")
    jsonl.write_curated(spark.range(1).select("id"), target)
    real, left = Folder.move, [moves + 1]  # the first move marks the new folder as complete

    def move(self, old, new):
        if not left[0]:
            raise KeyboardInterrupt
        left[0] -= 1
        real(self, old, new)

    monkeypatch.setattr(Folder, "move", move)
    if moves == 2:
        monkeypatch.setattr(publish, "_forward", lambda folder, run: (folder.move(folder.path, folder.beside("old", run)), folder.move(folder.beside("ready", run), folder.path)))
        jsonl.write_curated(spark.range(5, 6).select("id"), target)
    else:
        with pytest.raises(KeyboardInterrupt):
            jsonl.write_curated(spark.range(5, 6).select("id"), target)
    monkeypatch.undo()
    assert len(os.listdir(tmp_path)) > 1 or moves == 1
    publish.recover(spark, target)
    assert contents(spark, target) == ['{"id":5}'] and os.listdir(tmp_path) == ["out"]


def test_folders_of_dead_runs_go_and_those_of_live_ones_stay(spark, tmp_path):
    target = str(tmp_path / "out")
    (tmp_path / ".out.next-other").mkdir()
    jsonl.write_curated(spark.range(1).select("id"), target)
    assert sorted(os.listdir(tmp_path)) == [".out.next-other", "out"]
    publish.recover(spark, target, dead_after=-1)
    assert os.listdir(tmp_path) == ["out"]


def test_jobs_keep_the_old_target_when_they_fail(spark, tmp_path):
    source, target = tmp_path / "in.json", str(tmp_path / "out")
    source.write_text('{"text":"%s"}\n' % (LONG * 2))
    for job in (run_curation, run_noise):
        job(spark, str(source), target)
        old = contents(spark, target)
        source.write_text('{"other":1}\nno json\n' if job is run_curation else "\n")
        with pytest.raises(ValueError):
            job(spark, str(source), target)
        assert contents(spark, target) == old
        source.write_text('{"text":"%s"}\n' % (LONG * 2))


def samples(spark, ids):
    return spark.createDataFrame([(i, LONG + i, "fraud", 5) for i in ids], "id string, text string, label string, score int")


def ids(spark, path):
    return sorted(r["id"] for r in spark.read.schema("id string").json(str(path)).collect())


@pytest.mark.parametrize("moves", range(5))
def test_paired_samples_are_in_both_once_whatever_crashed(spark, tmp_path, monkeypatch, moves):
    texts, gold = str(tmp_path / "texts"), str(tmp_path / "gold")
    assert reports.append_pair_sink(samples(spark, "ab"), texts, gold, "mine", reports.CONTENT)
    real, left = Folder.move, [moves]

    def move(self, old, new):
        if not left[0]:
            raise KeyboardInterrupt
        left[0] -= 1
        real(self, old, new)

    monkeypatch.setattr(Folder, "move", move)
    try:
        reports.append_pair_sink(samples(spark, "cd").repartition(2, "id"), texts, gold, "mine", reports.CONTENT)
    except KeyboardInterrupt:
        pass
    monkeypatch.undo()
    reports.append_pair_sink(samples(spark, "cd").repartition(2, "id"), texts, gold, "mine", reports.CONTENT)
    assert ids(spark, texts) == ids(spark, gold) == list("abcd")
    assert not reports.append_pair_sink(samples(spark, "ba"), texts, gold, "mine", reports.CONTENT)  # by content, in any order
    assert reports.append_pair_sink(samples(spark, "ba"), texts, gold, "mine", batch="again")
    assert ids(spark, texts) == ids(spark, gold) == list("aabbcd")


def test_a_batch_that_was_never_complete_is_written_anew(spark, tmp_path, monkeypatch):
    texts, gold = str(tmp_path / "texts"), str(tmp_path / "gold")
    monkeypatch.setattr(PairedSink, "_set", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        reports.append_pair_sink(samples(spark, "ab"), texts, gold, "mine", batch="one")
    monkeypatch.undo()
    assert reports.append_pair_sink(samples(spark, "cd"), texts, gold, "mine", batch="one")
    assert ids(spark, texts) == ids(spark, gold) == list("cd")
    with pytest.raises(ValueError):
        reports.append_pair_sink(samples(spark, "e"), texts, gold, "mine", batch="../x")


def asker(log, dies_at=None):
    """A client that writes down every prompt it answers, and whose worker process ends at a prompt."""

    def make():
        def ask(prompts):
            if dies_at is not None and dies_at in prompts:
                os._exit(1)
            with open(log, "a") as file:
                file.writelines(f"{p}\n" for p in prompts)
            return [None if p.startswith("nothing") else f"answer to {p}" for p in prompts]

        return ask

    return make


def test_a_lost_worker_asks_nothing_twice(spark, tmp_path):
    log, ledger = tmp_path / "log", str(tmp_path / "ledger")
    rows = spark.createDataFrame([(i, f"prompt {i % 40}") for i in range(100)], "id int, prompt string")
    with pytest.raises(Exception, match="crashed"):
        score_with(rows, asker(log, "prompt 39"), ledger=ledger, model="m", batch_rows=4).count()
    told = known_answers(read_ledger(spark, ledger)).count()
    assert 0 < told < 40
    found = score_with(rows, asker(log), ledger=ledger, model="m", batch_rows=4)
    assert found.columns == ["id", "prompt", "answer", "error"]
    assert sorted(tuple(r) for r in found.collect()) == [(i, f"prompt {i % 40}", f"answer to prompt {i % 40}", None) for i in range(100)]
    asked = Counter(log.read_text().splitlines())
    assert len(asked) == 40 and sum(asked.values()) <= 40 + 40 - told  # what was committed is not asked again
    before = sum(asked.values())
    score_with(rows, asker(log), ledger=ledger, model="m").collect()
    found.collect()
    assert len(log.read_text().splitlines()) == before
    score_with(rows, asker(log), ledger=ledger, model="other").collect()
    assert len(log.read_text().splitlines()) == before + 40


def test_what_finished_tasks_were_told_survives_a_failing_job(spark, tmp_path):
    """One task at a time: the batch that the second task never got answered is the only one that is asked later."""
    log, ledger = tmp_path / "log", str(tmp_path / "ledger")
    first = spark.createDataFrame([(f"a{i}",) for i in range(4)], "prompt string")
    both = first.union(spark.createDataFrame([("stop",)], "prompt string"))
    score_with(first, asker(log), ledger=ledger, batch_rows=4).collect()
    with pytest.raises(Exception, match="crashed"):
        score_with(both, asker(log, "stop"), ledger=ledger, batch_rows=4).collect()
    score_with(both, asker(log), ledger=ledger, batch_rows=4).collect()
    assert Counter(log.read_text().splitlines()) == Counter(["a0", "a1", "a2", "a3", "stop"])


def test_ledger_errors_nulls_and_structured_prompts(spark, tmp_path):
    ledger = str(tmp_path / "ledger")

    def broken():
        return lambda prompts: [1 / 0 if p and p["content"] == "bad" else "fine" for p in prompts]

    rows = spark.createDataFrame([(1, ("user", "good")), (2, ("user", "bad")), (3, None)], "id int, prompt struct<role:string,content:string>")
    got = {r["id"]: (r["answer"], r["error"]) for r in score_with(rows, broken, ledger=ledger).collect()}
    assert got == {1: ("fine", None), 2: (None, "ZeroDivisionError: division by zero"), 3: ("fine", None)}
    mended = score_with(rows, lambda: lambda prompts: ["mended"] * len(prompts), ledger=ledger).collect()
    assert {r["id"]: (r["answer"], r["error"]) for r in mended} == {1: ("fine", None), 2: ("mended", None), 3: ("fine", None)}
    assert score_with(rows.where("id > 5"), broken, ledger=ledger).collect() == []


def fraud_worker():
    return lambda prompts: ["Result: fraud" for _ in prompts]


def fair_judge():
    return lambda prompts: ["Score: PASS" for _ in prompts]


def test_judge_job_numbers_in_file_order_and_asks_once(spark, tmp_path):
    """Pairs of the library's own job have no id; the report's numbers are their places in the files."""
    from callsift.__main__ import arguments, run

    pairs = tmp_path / "pairs"
    pairs.mkdir()
    for part in range(3):
        lines = [f'{{"input":"call {part} {i}","output":"{"fraud" if i % 2 else "legitimate"}"}}' for i in range(12)]
        (pairs / f"part-{part:05d}.json").write_text("\n".join(lines) + "\n")
    report, ledger = str(tmp_path / "report"), str(tmp_path / "ledger")
    models = ["--model", "tests.test_commit:fraud_worker", "--judge-model", "tests.test_commit:fair_judge", "--ledger", ledger]
    for _ in range(2):
        assert run(spark, arguments(["judge", str(pairs), report, *models])) == {"rows": 36}
    rows = spark.read.option("header", True).csv(report).select(F.col("id").cast("int"), "true_label").orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(1, 37))
    assert [r["true_label"] for r in rows] == ["legitimate", "fraud"] * 18
    told = read_ledger(spark, ledger)
    assert told.count() == told.select("digest").distinct().count() and told.select("run").distinct().count() == 2  # worker and judge of the first run
