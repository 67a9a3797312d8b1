import hashlib
import random

import pytest
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions import masking
from callsift.functions.once import pin
from callsift.operators import dedup, gates, ids, labels, noise, scoring, skew, splits


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


# --- numbers ------------------------------------------------------------------------------------


def test_number_by_key_over_many_ranges(spark):
    keys = random.Random(1).sample(range(10**6), 2000)
    frame = spark.createDataFrame([(k, f"t{k % 7}") for k in keys], "k int, t string").repartition(5)
    got = ids.number_by_key(frame, ["t", "k"], partitions=40)
    want = {k: n for n, (t, k) in enumerate(sorted((f"t{k % 7}", k) for k in keys))}
    assert {r.k: r.row_id for r in got.collect()} == want


def test_number_by_key_small_and_empty(spark):
    frame = spark.createDataFrame([("b",), ("a",)], "k string")
    assert sorted(rows_of(ids.number_by_key(frame, ["k"], start=5))) == [("a", 5), ("b", 6)]
    assert ids.number_by_key(frame.limit(0), ["k"]).collect() == []


def test_number_by_position_is_consecutive_on_a_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).repartition(6).write.parquet(path)
    got = ids.number_by_position(spark.read.parquet(path).where("id % 3 <> 0"), start=10)
    assert sorted(r.row_id for r in got.collect()) == list(range(10, 10 + 666))
    with pytest.raises(ValueError):
        ids.number_by_position(spark.range(10).repartition(3))


def test_fallback_ids(spark):
    frame = spark.createDataFrame([(1, "c", "i"), (2, None, "i"), (3, None, None)], "n int, call_id string, id string")
    got = ids.position_fallback_id(frame, order_by=["n"]).orderBy("n")
    assert [r.call_id for r in got.collect()] == ["c", "i", "CALL_0002"]
    only = ids.position_fallback_id(frame.select("n"), order_by=["n"]).orderBy("n")
    assert [r.call_id for r in only.collect()] == ["CALL_0000", "CALL_0001", "CALL_0002"]


# --- splits ---------------------------------------------------------------------------------


def python_split(keys, seed=42):
    order = sorted(keys, key=lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest())
    train = int(len(keys) * 0.70)
    end = train + int(len(keys) * 0.15)
    return {k: "train" if i < train else "validation" if i < end else "test" for i, k in enumerate(order)}


@pytest.mark.parametrize("n", [0, 1, 2, 7, 10, 20, 90, 333, 1000])
def test_exact_split(spark, n):
    keys = [f"doc-{i:05d}" for i in range(n)]
    frame = spark.createDataFrame([(k, "x") for k in keys], "id string, text string")
    got = {r.id: r.split for r in splits.seeded_split_exact(frame, ["id"]).collect()}
    assert got == python_split(keys)


def test_exact_split_does_not_depend_on_partitions(spark):
    frame = spark.range(500).select(F.col("id").cast("string").alias("id"))
    one = sorted(rows_of(splits.seeded_split_exact(frame.repartition(1), ["id"])))
    assert one == sorted(rows_of(splits.seeded_split_exact(frame.repartition(8), ["id"])))


def test_exact_split_with_a_third_of_the_rows_equal(spark, monkeypatch):
    monkeypatch.setattr(splits, "_FEW", 4)
    for hot in range(6):
        keys = [f"hot{hot}"] * 200 + [f"k{i}" for i in range(400)]
        frame = spark.createDataFrame([(k,) for k in keys], "id string").repartition(4)
        got = splits.seeded_split_exact(frame, ["id"])
        assert {r.split: r.rows for r in splits.split_sizes(got).collect()} == {"train": 420, "validation": 90, "test": 90}
        assert sorted(r.id for r in got.collect()) == sorted(keys)


def test_exact_split_when_all_rows_are_equal(spark):
    frame = spark.range(100).select(F.lit("x").alias("id"))
    got = splits.split_sizes(splits.seeded_split_exact(frame, ["id"]))
    assert {r.split: r.rows for r in got.collect()} == {"train": 70, "validation": 15, "test": 15}


def test_exact_split_needs_a_telling_key(spark):
    frame = spark.createDataFrame([("x", str(i)) for i in range(10)], "id string, text string")
    with pytest.raises(ValueError):
        splits.seeded_split_exact(frame, ["id"])


def test_hash_split_is_roughly_right(spark):
    frame = spark.range(20000).select(F.col("id").cast("string").alias("id"))
    sizes = {r.split: r.rows for r in splits.split_sizes(splits.seeded_split_hash(frame, ["id"])).collect()}
    assert abs(sizes["train"] - 14000) < 400 and abs(sizes["validation"] - 3000) < 300


def test_leakage_is_found(spark):
    frame = spark.createDataFrame(
        [("a", "train"), ("a", "test"), ("b", "train"), ("b", "validation"), ("b", "test"), ("c", "test")], "input string, split string"
    )
    got = {(r.split_a, r.split_b): r.shared_texts for r in splits.leakage_check(frame).collect()}
    assert got == {("train", "validation"): 1, ("train", "test"): 2, ("validation", "test"): 1}
    assert rows_of(splits.split_disjoint(frame)) == [(False,)]
    assert rows_of(splits.split_disjoint(frame.where("input = 'c'"))) == [(True,)]


# --- skew -----------------------------------------------------------------------------------


def test_lookup_join_equals_a_plain_join(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"k{i}" if i % 3 == 1 else None) for i in range(900)]
    left = spark.createDataFrame(rows, "n int, key string")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k4", 3), ("other", 4)], "key string, v int")
    assert skew.hot_keys(left, "key", 0.1, 1) == ["hot"] and skew.hot_keys(left, "key", 0.1) == []
    for how in ("inner", "left"):
        got = sorted(rows_of(skew.lookup_join(left, right, "key", how, 0.1, 1)), key=repr)
        assert got == sorted(rows_of(left.join(right, "key", how)), key=repr)
        assert got == sorted(rows_of(skew.lookup_join(left, right, "key", how, None)), key=repr)


def test_lookup_join_keeps_hot_rows_where_they_are(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"))
    right = left.distinct().withColumn("v", F.lit(1))
    plan = skew.lookup_join(left, right, "key", share=0.1, rows=1)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Union" in plan


def test_first_per_key_cuts_groups_before_the_shuffle(spark):
    frame = spark.range(3000).select("id", F.concat(F.lit("same"), F.floor(F.col("id") / 9999)).alias("text"))
    kept = dedup.keep_first_duplicate(frame)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit", plan.index("Exchange hashpartitioning")) > 0
    assert rows_of(kept) == [(0, "same0")]


# --- duplicates -----------------------------------------------------------------------------


def dups(spark):
    rows = [(3, "a"), (1, "a"), (2, "a"), (4, "Ruf 123456789"), (5, "Ruf 987654321"), (6, "b")]
    return spark.createDataFrame(rows, "id int, text string")


def test_duplicates(spark):
    frame = dups(spark)
    assert sorted(r.id for r in dedup.duplicate_groups(frame).collect()) == [1, 2, 3]
    assert sorted(r.id for r in dedup.keep_first_duplicate(frame).collect()) == [1, 4, 5, 6]
    assert sorted(r.id for r in dedup.later_duplicates(frame).collect()) == [2, 3]
    left = dedup.drop_duplicates_by_id(frame, dedup.later_duplicates(frame))
    assert sorted(rows_of(left)) == sorted(rows_of(dedup.keep_first_duplicate(frame)))


def test_masking_makes_duplicates(spark):
    masked = pin(dups(spark), "text", masking.mask_pii(F.col("text")))
    assert sorted(r.id for r in dedup.keep_first_duplicate(masked).collect()) == [1, 4, 6]
    assert rows_of(dedup.curation_stats(masked, least=2)) == [(6, 4, 1, 1, 5, 500 / 6)]
    assert rows_of(dedup.curation_stats(masked.limit(0))) == [(0, 0, 0, 0, 0, 0.0)]


def test_pin_keeps_column_order_and_blocks_pushdown(spark):
    frame = dups(spark)
    assert pin(frame, "text", F.upper("text")).columns == ["id", "text"]
    assert pin(frame, "more", F.upper("text")).columns == ["id", "text", "more"]
    plan = pin(frame, "text", F.upper("text")).where(F.length("text") > 3)
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("upper(") == 1


# --- gold -----------------------------------------------------------------------------------


def test_gold_rules(spark):
    rows = [
        (1, "a", "fraud", None), (2, "b", None, "legitimate"), (3, "c", "fraud", "legitimate"), (4, "d", "", ""),
        (5, "a", "legitimate", None), (6, "a", "", None), (7, None, "fraud", None), (8, "", "fraud", None),
    ]
    gold = spark.createDataFrame(rows, "at int, id string, label string, fraud_type string")
    got = labels.gold_last_wins(gold.repartition(3), ["at"])
    assert sorted(rows_of(got)) == [("a", "legitimate"), ("b", "legitimate"), ("c", "fraud")]
    assert sorted(rows_of(labels.gold_last_wins(gold.drop("fraud_type"), ["at"])))[0] == ("a", "legitimate")


def test_call_id_beats_id(spark):
    docs = spark.createDataFrame([("a", "b", "x"), ("", "b", "y"), (None, None, "z")], "call_id string, id string, text string")
    gold = spark.createDataFrame([("a", "fraud"), ("b", "legitimate")], "id string, label string")
    pairs = labels.to_sft_pair(labels.attach_gold(docs, gold))
    assert sorted(rows_of(pairs)) == [("x", "fraud"), ("y", "legitimate")]
    assert rows_of(labels.match_stats(docs, gold)) == [(3, 2, 1)]
    assert labels.attach_gold(docs, gold, "left").count() == 3
    assert labels.map_columns(pairs).columns == ["question", "answer"]


def test_label_distribution(spark):
    gold = spark.createDataFrame([("fraud",)] * 1 + [("legitimate",)] * 3, "label string")
    assert rows_of(labels.label_distribution(gold)) == [(4, 3, 1, 0.25, True)]
    assert rows_of(labels.label_distribution(gold.where("label = 'fraud'"))) == [(1, 0, 1, 1.0, False)]
    assert rows_of(labels.label_distribution(gold.limit(0))) == [(0, 0, 0, 0.0, False)]


# --- noise ----------------------------------------------------------------------------------


def many_calls(spark, n=4000):
    return spark.range(n).select(F.format_string("doc-%05d", "id").alias("call_id"), F.lit("Grüße, schöner Tag, süß " * 4).alias("text"))


def test_noise_mix_and_shape(spark):
    frame = many_calls(spark)
    stats = {r.branch: r.calls for r in noise.noise_stats(frame).collect()}
    assert sum(stats.values()) == 4000
    for name, share in V.NOISE_SHARES.items():
        assert abs(stats[name] / 4000 - share) < 0.015
    noisy = noise.inject_noise(frame)
    kinds = {r.noise_type: r["count"] for r in noisy.groupBy("noise_type").count().collect()}
    assert kinds == {
        "none": stats["clean"] + stats["duplicate"], "exact_duplicate": stats["duplicate"], "pii_injection": stats["pii"],
        "garbage_text": stats["garbage"], "encoding_error": stats["encoding"],
    }
    assert noisy.where("is_clean <> (noise_type = 'none')").count() == 0
    assert rows_of(noise.noise_presence(noisy)) == [(True, True, True, True)]
    assert sorted(rows_of(noisy)) == sorted(rows_of(noise.inject_noise(frame.repartition(7))))


def test_noise_with_other_shares_and_seed(spark):
    frame = many_calls(spark, 200)
    every = noise.inject_noise(frame, shares={"garbage": 1.0})
    assert every.where("noise_type = 'garbage_text'").count() == 200
    assert sorted(rows_of(noise.inject_noise(frame, seed=1))) != sorted(rows_of(noise.inject_noise(frame, seed=2)))


def test_empty_texts_leave(spark):
    frame = spark.createDataFrame([("a", ""), ("b", None), ("c", "x")], "call_id string, text string")
    assert noise.inject_noise(frame, shares={}).count() == 1
    assert rows_of(noise.noise_stats(frame, shares={"pii": 1.0})) == [("pii", 1)]


# --- gates --------------------------------------------------------------------------------------


def test_gates(spark):
    lines = spark.createDataFrame([('{"text": "a"}',), ('{"text": null}',), ('{"body": 1}',)], "value string")
    assert rows_of(gates.schema_gate(lines)) == [(3, 1, False)]
    assert rows_of(gates.schema_gate(lines.limit(2))) == [(2, 0, True)]
    assert rows_of(gates.schema_gate(lines.limit(0))) == [(0, 0, False)]
    texts = spark.createDataFrame([("x" * 20,)] * 19 + [(" short ",)], "text string")
    assert rows_of(gates.short_ratio_gate(texts)) == [(20, 1, True)]
    assert rows_of(gates.short_ratio_gate(texts.limit(0).unionByName(texts.where("length(text) < 20")))) == [(1, 1, False)]
    assert rows_of(gates.row_relation_gate(texts, lines)) == [(20, 3, True)]
    assert rows_of(gates.row_relation_gate(lines, texts)) == [(3, 20, False)]
    assert rows_of(gates.row_relation_gate(texts, lines.limit(0))) == [(20, 0, False)]


# --- scoring ------------------------------------------------------------------------------------


def test_score_with_isolates_bad_rows(spark):
    def make():
        def ask(prompts):
            if "bad" in prompts:
                raise RuntimeError("boom")
            return [p.upper() for p in prompts]

        return ask

    frame = spark.createDataFrame([(i, "bad" if i == 3 else f"p{i}", None) for i in range(20)], "n int, prompt string, other int")
    got = {r.n: r for r in scoring.score_with(frame, make, batch_rows=8, tasks=2).collect()}
    assert len(got) == 20 and got[3].answer is None and got[3].error == "RuntimeError: boom"
    assert all(got[n].answer == f"P{n}" and got[n].error is None and got[n].other is None for n in got if n != 3)


def test_score_with_makes_one_client_per_partition(spark, tmp_path):
    mark = str(tmp_path)

    def make():
        import os
        import uuid

        open(os.path.join(mark, uuid.uuid4().hex), "w").close()
        return lambda prompts: [""] * len(prompts)

    scoring.score_with(spark.range(100).select(F.lit("x").alias("prompt")), make, batch_rows=4, tasks=3).count()
    scoring.score_with(spark.range(100).select(F.lit("x").alias("prompt")), make, batch_rows=4, tasks=3).collect()
    assert 3 <= len(list(tmp_path.iterdir())) <= 6


def test_wrong_answer_count_is_an_error(spark):
    frame = spark.createDataFrame([("a",), ("b",)], "prompt string").coalesce(1)
    got = scoring.score_with(frame, lambda: lambda prompts: ["x"] * (len(prompts) + 1)).collect()
    assert [r.answer for r in got] == [None, None] and "2 answers for 1 prompts" in got[0].error


def test_attempts(spark):
    rows = [("a", 0, 3), ("a", 1, 4), ("a", 2, 5), ("b", 0, 2), ("c", 3, 5), ("d", 0, 3)]
    frame = spark.createDataFrame(rows, "id string, attempt int, score int")
    assert rows_of(scoring.first_accepted_attempt(frame)) == [("a", 1, 4)]
    assert sorted(rows_of(scoring.first_accepted_attempt(frame, least=3))) == [("a", 0, 3), ("d", 0, 3)]


def test_blank_rows_are_set_aside(spark):
    frame = spark.createDataFrame([("a",), ("",), ("   \n  ",), (None,)], "text string")
    good, blank = scoring.reject_blank_input(frame)
    assert good.count() == 1 and blank.count() == 3
    assert scoring.drop_empty_input(frame, "text").count() == 2


def test_filter_protocol(spark):
    frame = spark.createDataFrame([("abc",), ("a",)], "text string")
    assert scoring.apply_filter(frame, "text", F.length, lambda s: s > 1).columns == ["text"]
    assert rows_of(scoring.apply_filter(frame, "text", F.length, lambda s: s > 1, "n")) == [("abc", 3)]
    assert rows_of(scoring.apply_modifiers(frame, "text", F.upper, F.reverse)) == [("CBA",), ("A",)]
