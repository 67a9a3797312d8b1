"""Counts at every stage of the curation job, layered repair, and running counts that keep changes only."""

import json
import os

import pytest
from pyspark.sql import functions as F

from callsift.functions.masking import mask_pii
from callsift.functions.text import repair_layers, repair_unicode, score_length
from callsift.operators.dedup import curation_stats
from callsift.plans.curate import run_curation
from callsift.streaming import live

LONG = "Guten Tag, hier spricht die Bank, es geht um Ihr Konto Nummer eins. "


def misread(text, windows):
    data = text.encode()
    return "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in data) if windows else data.decode("latin-1")


@pytest.mark.parametrize("windows", [False, True])
def test_every_character_comes_back_from_every_layer(spark, windows):
    codes = [c for c in (*range(0xA0, 0x3000), *range(0x3000, 0xFFFF, 13), 0x1F600, 0x20000, 0x10FFFF) if not 0xD800 <= c < 0xE000]
    rows = []
    for c in codes:
        one = misread(f"a{chr(c)}b{chr(c)}", windows)
        rows += [(f"a{chr(c)}b{chr(c)}", one), (f"a{chr(c)}b{chr(c)}", misread(one, windows))]
    df = spark.createDataFrame(rows, "text string, broken string").repartition(8)
    assert df.where(repair_layers(F.col("broken")) != F.col("text")).isEmpty()


def test_samples_of_layered_repair(spark):
    deep = "ä"
    for _ in range(5):
        deep = misread(deep, True)
    cases = {"â€™": "’", "â‚¬ 5": "€ 5", "ðŸ˜€!": "😀!", "Ã¤Ã¶Ã¼ÃŸ": "äöüß", "plain": "plain", "": "", "déjà Â": "déjà Â", "Ã": "Ã", "ÀÀ": "ÀÀ", "í\xa0\x80": "í\xa0\x80", deep: "ä", "ö Ã¤ â€œxâ€\x9d": "ö ä “x”"}
    df = spark.createDataFrame([(a, b) for a, b in cases.items()] + [(None, None)], "broken string, text string")
    got = df.select("broken", "text", repair_layers(F.col("broken")).alias("r")).collect()
    assert [(r["broken"], r["r"]) for r in got] == [(r["broken"], r["text"]) for r in got]
    two = df.where("broken IN ('Ã¤Ã¶Ã¼ÃŸ', 'plain', 'Ã', '')")
    assert two.where(~repair_layers(F.col("broken")).eqNullSafe(repair_unicode(F.col("broken")))).isEmpty()


def test_counts_at_every_stage(spark, tmp_path):
    texts = [LONG + "1", LONG + "1", LONG.replace("Tag", "TÃ¤g"), "kurz", "", None, f"{LONG} Meine Mail ist a.b@web.de", f"{LONG} KÃ¶ln c.d@web.de", LONG + "2", f"{LONG} Meine Mail ist x.y@web.de"]
    source = tmp_path / "in.json"
    source.write_text("\n".join(json.dumps({"text": t}, ensure_ascii=False) for t in texts), encoding="utf-8")
    found = run_curation(spark, str(source), str(tmp_path / "out"))
    assert found["rows_in"] == 10 and found["repaired"] == 2 and found["masked"] == 3 and found["too_short"] == 3
    assert found["duplicates"] == 2 and found["kept"] == 5 == spark.read.text(str(tmp_path / "out")).count() and found["removed"] == 5
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("text", mask_pii(repair_unicode(F.col("text"))))
    query = curation_stats(df).first()
    assert all(query[x] == found[x] for x in ("rows_in", "too_short", "duplicates", "kept", "removed"))
    assert df.where(score_length(F.col("text")) < 50).count() == found["too_short"]


def test_running_counts_write_changes_and_stay_few(spark, tmp_path):
    source, table, state = tmp_path / "in", str(tmp_path / "counts"), str(tmp_path / "state")
    wanted = {}
    for step in range(9):
        labels = ["fraud"] * (step + 1) + ([f"rare{step}"] if step % 3 == 0 else [])
        for label in labels:
            wanted[label] = wanted.get(label, 0) + 1
        spark.createDataFrame([(x,) for x in labels], "label string").coalesce(1).write.mode("append").parquet(str(source))
        stream = live.arriving(spark, str(source), "label string")
        live.stream_fraud_counter(stream, table, state, compact_every=3).awaitTermination()  # each time from the checkpoint
        assert {r["label"]: r["calls"] for r in live.current_counts(spark, table).collect()} == wanted
    folders = os.listdir(table)
    assert len([f for f in folders if f.startswith("batch=")]) <= 6 and len([f for f in folders if f.startswith("upto=")]) <= 2
    last = max(f for f in folders if f.startswith("batch="))
    assert {r["label"] for r in spark.read.parquet(f"{table}/{last}").collect()} == {"fraud"}  # the others did not change
    again = spark.createDataFrame([("fraud", wanted["fraud"])], "label string, calls long")
    live.CountTable(spark, table).publish(again, int(last.partition("=")[2]), 3)  # a repeated batch changes nothing
    assert {r["label"]: r["calls"] for r in live.current_counts(spark, table).collect()} == wanted


def test_no_counts_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        live.current_counts(spark, str(tmp_path / "none"))
