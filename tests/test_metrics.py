import math
import random

import pytest

from callsift.operators import metrics


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "gold string, pred string")


def row(df):
    return df.first().asDict()


def python_report(pairs, labels):
    """Per-label precision, recall, F1 and support over answered pairs, straight from the definitions."""
    pairs = [(g, p) for g, p in pairs if p is not None]
    found = {}
    for label in labels:
        tp = sum(g == p == label for g, p in pairs)
        said, support = sum(p == label for _, p in pairs), sum(g == label for g, _ in pairs)
        precision, recall = (tp / said if said else 0.0), (tp / support if support else 0.0)
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        found[label] = (precision, recall, f1, support)
    return found


def test_perfect(spark):
    df = frame(spark, [("fraud", "fraud"), ("legitimate", "legitimate")] * 2)
    got = row(metrics.binary_metrics(df))
    assert got["accuracy"] == got["f1"] == 1.0
    assert row(metrics.macro_f1(df)) == {"macro_f1": 1.0}


def test_only_negative_answers(spark):
    got = row(metrics.binary_metrics(frame(spark, [("fraud", "legitimate")] * 2)))
    assert (got["precision"], got["recall"], got["f1"], got["fn"]) == (0.0, 0.0, 0.0, 2)


def test_nothing(spark):
    df = frame(spark, [])
    assert row(metrics.accuracy_percent(df)) == {"correct": 0, "total": 0, "accuracy_percent": 0.0}
    assert row(metrics.match_rate(df)) == {"match_rate_percentage": 0.0}
    assert row(metrics.macro_f1(df)) == {"macro_f1": 0.0}
    assert [r.support for r in metrics.class_report(df).collect()] == [0] * 5


@pytest.mark.parametrize("seed", range(3))
def test_against_definitions(spark, seed):
    rng = random.Random(seed)
    words = ["fraud", "legitimate", "unknown", None] if seed else ["fraud", "legitimate"]
    pairs = [(rng.choice(["fraud", "legitimate"]), rng.choice(words)) for _ in range(200)]
    df, answered = frame(spark, pairs), [(g, p) for g, p in pairs if p]
    want = python_report(pairs, ["fraud", "legitimate"])
    got = {r.name: r for r in metrics.class_report(df).collect()}
    for label, numbers in want.items():
        assert all(math.isclose(a, b) for a, b in zip(got[label][1:], numbers))
    total = sum(v[3] for v in want.values())
    weighted = [sum(v[i] * v[3] for v in want.values()) / total for i in range(3)]
    assert all(math.isclose(a, b) for a, b in zip(got["weighted avg"][1:4], weighted))
    assert all(math.isclose(a, b) for a, b in zip(row(metrics.weighted_prf(df)).values(), weighted))
    assert ("micro avg" in got) == bool(seed) and ("accuracy" in got) == (not seed)
    correct = sum(g == p for g, p in answered)
    if not seed:
        assert math.isclose(got["accuracy"].f1, correct / len(answered))
    run = row(metrics.run_metrics(df))
    assert math.isclose(run["accuracy"], correct / len(answered))
    assert math.isclose(run["match_rate_percentage"], 100 * correct / len(pairs))
    labels = sorted({x for pair in answered for x in pair})
    macro = sum(v[2] for v in python_report(pairs, labels).values()) / len(labels)
    assert math.isclose(row(metrics.macro_f1(df))["macro_f1"], macro)


def test_confusion(spark):
    df = frame(spark, [("fraud", "fraud"), ("fraud", "legitimate"), ("fraud", "unknown"), ("legitimate", "fraud"), ("legitimate", None)])
    assert [tuple(r) for r in metrics.confusion_matrix(df).collect()] == [("fraud", 1, 1), ("legitimate", 1, 0)]
    assert {tuple(r) for r in metrics.confusion_open(df).collect()} == {
        ("fraud", "fraud", 1), ("fraud", "legitimate", 1), ("fraud", "unknown", 1), ("legitimate", "fraud", 1)
    }
    assert row(metrics.unparsed_count(df, "unknown")) == {"unparsed": 1}


def test_judge_and_match(spark):
    verdicts = spark.createDataFrame([("PASS",), ("FAIL",), (None,), ("PASS",)], "judge_score string")
    assert row(metrics.judge_pass_rate(verdicts)) == {"passed": 2, "total": 4, "pass_rate": 50.0}
    texts = spark.createDataFrame([(" A", "a"), ("b", "c")], "l string, r string")
    assert row(metrics.exact_match(texts, "l", "r")) == {"exact_match": 0.5}


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 2.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    assert [r[0] for r in df.select(metrics.cosine(df.a, df.b)).collect()] == [1.0, 0.0, None]
