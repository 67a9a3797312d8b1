"""Cosine of weighted term counts, against a plain version."""

import math
import re
from collections import Counter
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from callsift.operators.similarity import SLOTS, mean_similarity, slot_weights, term_slots, text_similarity
from callsift.workload import labelling


def plain(pairs, slots=SLOTS):
    counts = [[Counter(int(md5(w.encode()).hexdigest()[:8], 16) % slots for w in re.findall(r"[^\W_]+", (t or "").lower())) for t in p] for p in pairs]
    held = Counter(s for p in counts for c in p for s in c)
    weight = {s: math.log((1 + 2 * len(pairs)) / (1 + n)) + 1 for s, n in held.items()}
    found = []
    for a, b in counts:
        inner = lambda x, y: sum(n * y[s] * weight[s] ** 2 for s, n in x.items())
        found.append(inner(a, b) / math.sqrt(inner(a, a) * inner(b, b)) if a and b else None)
    return found


PAIRS = [
    ("The caller asked for a PIN", "the caller asked, twice, for a pin!"),
    ("fraud fraud fraud call", "fraud call call"),
    ("Größe über alles", "größe ÜBER nichts"),
    ("same words here", "Here same WORDS"),
    ("nothing shared", "at all in common"),
    (None, "text"), ("text", ""), ("...", "text"), (None, None),
    ("fraud fraud fraud call", "fraud call call"),
    ("long " * 30_000 + "tail", "tail " * 20_000 + "long"),
]


@pytest.mark.parametrize("slots", [SLOTS, 3])
def test_like_the_plain_version(spark, slots):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(PAIRS)], "i int, `a b` string, r string").repartition(3)
    got = dict(text_similarity(df, "a b", "r", slots=slots).select("i", "similarity").collect())
    for i, wanted in enumerate(plain(PAIRS, slots)):
        assert got[i] is None if wanted is None else abs(got[i] - wanted) < 1e-9, (i, got[i], wanted)
    if slots == SLOTS:
        assert got[3] == pytest.approx(1.0) and got[4] == 0.0


def test_empty_table_clashing_names_and_mean(spark):
    df = spark.createDataFrame(PAIRS, "l string, r string").selectExpr("l", "r", "'x' AS slot", "1 AS n", "2 AS weights", "3 AS similarity", "4 AS id", "5 AS count")
    out = text_similarity(df, "l", "r")
    assert sorted(out.columns) == sorted(df.columns) and out.count() == len(PAIRS)
    mean = mean_similarity(out).first()
    known = [x for x in plain(PAIRS) if x is not None]
    assert (mean["compared"], mean["total"]) == (len(known), len(PAIRS))
    assert abs(mean["mean_similarity"] - sum(known) / len(known)) < 1e-9
    assert text_similarity(df.limit(0), "l", "r").count() == 0
    none = mean_similarity(text_similarity(df.limit(0), "l", "r")).first()
    assert tuple(none) == (None, 0, 0)


def test_rows_are_not_shuffled(spark):
    """Only counts per slot move; the table of weights has a fixed size."""
    df = spark.createDataFrame(PAIRS, "l string, r string")
    weights = slot_weights(df, ["l", "r"])
    assert len(weights) == SLOTS and weights.min() > 0
    plan = text_similarity(df, "l", "r")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and plan.count("ArrowEvalPython") == 1


def test_a_text_of_several_rows_is_hashed_once(spark):
    """Columns of slots give what the texts give, and the query joins slots: no text is cut into terms again behind a join."""
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(PAIRS)], "i int, l string, r string")
    slots = df.select("i", term_slots(F.col("l")).alias("l"), term_slots(F.col("r")).alias("r"))
    assert dict(text_similarity(slots, "l", "r").select("i", "similarity").collect()) == dict(text_similarity(df, "l", "r").select("i", "similarity").collect())
    plan = labelling.text_similarity(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "regexp" not in plan
