import json

import pytest
from pyspark.sql import functions as F

from callsift.functions import answers as an, jsontext, prompts as pr
from tests.test_text import evaluate

ANSWERS = [
    "fraud", " Legitimate.\n", "fraudulent", "illegitimate", "fraud or legitimate", "legitimate or fraud",
    "fraudulent, illegitimate", "no idea", "", "Result: fraud", "RESULT: LEGITIMATE", "Result: legitimate, not fraud", None,
]
EXPECTED = {
    an.parse_contains_raw: [
        "fraud", "legitimate", "fraud", "legitimate", "fraud", "legitimate",
        "fraudulent, illegitimate", "no idea", "", "fraud", "legitimate", "legitimate", None,
    ],
    an.parse_contains: [
        "fraud", "legitimate", "fraud", "legitimate", "fraud", "legitimate",
        "unknown", "unknown", "unknown", "fraud", "legitimate", "legitimate", None,
    ],
    an.parse_result_tag: [
        "fraud", "legitimate", "unknown", "unknown", "fraud", "legitimate",
        "unknown", "unknown", "unknown", "fraud", "legitimate", "legitimate", None,
    ],
    an.parse_fraud_first: [
        "fraud", "legitimate", "fraud", "legitimate", "fraud", "fraud",
        "fraud", "unparsed", "unparsed", "fraud", "legitimate", "fraud", None,
    ],
    an.parse_binary: [
        "fraud", "legitimate", "fraud", "legitimate", "fraud", "fraud",
        "fraud", "legitimate", "legitimate", "fraud", "legitimate", "fraud", None,
    ],
}


@pytest.mark.parametrize("parse", EXPECTED, ids=lambda p: p.__name__)
def test_parsers(spark, parse):
    assert evaluate(spark, parse, ANSWERS) == EXPECTED[parse]


def test_parse_binary_reads_the_last_response(spark):
    assert evaluate(spark, an.parse_binary, ["fraud ### Response:\nfraud ### Response:\n ok"]) == ["legitimate"]


def test_parse_with_confidence(spark):
    values = ["clearly fraud, hang up", "all legit here", "label:FRAUD!", "", " \t", "hard to say", None]
    got = [tuple(r) for r in evaluate(spark, an.parse_with_confidence, values)]
    assert got == [("fraud", 1.0), ("legit", 1.0), ("fraud", 1.0)] + [("unknown", 0.0)] * 4


def test_parse_judge(spark):
    assert evaluate(spark, an.parse_judge, ["Score: PASS", "x score: pass y", "Score: FAIL", "", None]) == ["PASS", "PASS", "FAIL", "FAIL", None]


def test_gold_mappers(spark):
    values = ["Betrug", " KEIN Betrug ", "fraud", "legitimate", "", None]
    assert evaluate(spark, an.gold_de, values) == ["fraud"] + ["legitimate"] * 5
    assert evaluate(spark, an.gold_de_simple, values) == ["fraud", "fraud"] + ["legitimate"] * 4
    assert evaluate(spark, an.gold_plain, values) == ["betrug", "kein betrug", "fraud", "legitimate", "", ""]
    assert evaluate(spark, an.gold_exact, values) == ["Betrug", "KEIN Betrug", "fraud", "legitimate", "", ""]
    assert evaluate(spark, an.gold_normalized, [" Fraud", "legitimate ", "x"]) == ["fraud", "legitimate", "unparsed"]


def test_is_json_agrees_with_python(spark):
    texts = [
        '{"a": 1}', ' {"a": 1} ', '{"a": 1} x', '{"a": 1}}', '{"a": 1}]', '{"a": 1},', "[1, 2]", "1, 2", "1], [2", '1, "w": 2',
        "12 Uhr", "12", '"x"', "null", "true", "{broken", "", "{'a': 1}", '{"a": 1}{"b": 2}', '{"a": "x\ny"}', "1 //", "]",
    ]

    def python(text):
        try:
            json.loads(text)
            return True
        except ValueError:
            return False

    assert evaluate(spark, jsontext.is_json, texts) == [python(t) for t in texts]
    assert evaluate(spark, jsontext.is_json, [None]) == [False]


def test_unwrap(spark):
    chat = ['{"choices": [{"message": {"content": " ja\\n"}}]}', '{"error": 1}', "no", None, '{"choices": []}']
    assert evaluate(spark, an.unwrap_chat, chat) == ["ja", None, None, None, None]
    assert evaluate(spark, an.unwrap_completion, ['{"choices": [{"text": " ja "}]}', '{"error": 1}']) == ["ja", None]
    assert evaluate(spark, an.unwrap_guarded, ['{"content": "c"}', "plain", '{"other": 1}']) == ["c", "plain", '{"other": 1}']


def test_clean_answer(spark):
    raw = [
        '```json\n{"text": "Kunde: a\\nAgent: b"}\n```', '{"text": "ä \\d"}', "kein \\ JSON", '{"id": 1}', "[1]", '{"text": null}',
        '{"text": 5}', "12 Uhr", None, '{"text": "x"} Ende', '```\n{"text": "u\\u00e4"}```',
    ]
    got = evaluate(spark, an.clean_answer, raw)
    assert got == [
        "Kunde: a\nAgent: b", "ä \\d", "kein / JSON", '{"id": 1}', None, None, None, "12 Uhr", None, '{"text": "x"} Ende', "uä",
    ]
    assert evaluate(spark, lambda c: an.clean_answer(c, False), ['{"id": 1}']) == [""]


def test_backslashes(spark):
    values = [r"\d", r"\n", r"\u12", r"\u00e4", r"a\\b", "x\\", r"C:\Users"]
    assert evaluate(spark, an.double_bad_backslashes, values) == [_python_fix(v) for v in values]


def _python_fix(text):
    import re

    return re.sub(r'\\(?!["\\/bfnrt]|u[0-9a-fA-F]{4})', r"\\\\", text)


def test_judge_score(spark):
    values = [
        '{"score": 4}', '{"score": "5"}', '{"score": " 3 "}', '{"score": 4.7}', '{"score": "4.7"}', '{"score": true}', '{"score": null}',
        '{"other": 4}', "[4]", "broken", '```json\n{"score": 2}\n```', "", None, '{"score": 4} ok',
    ]
    assert evaluate(spark, an.judge_score, values) == [4, 5, 3, 4, 0, 1, 0, 0, 0, 0, 2, 0, 0, 0]


def test_training_text_by_columns(spark):
    rows = spark.createDataFrame([("a", "b", "c")], "input string, output string, text string")
    assert rows.select(pr.format_training_text(rows.columns, "<e>")).first()[0] == "### Instruction:\na\n\n### Response:\nb<e>"
    assert rows.select(pr.format_training_text(["text"], "<e>")).first()[0] == "c<e>"
    assert rows.select(pr.format_training_text(["output"], "<e>")).first()[0] == "b<e>"


def test_messages(spark):
    one = spark.range(1).select(
        pr.messages_eval(F.lit("T"), "zero-shot").alias("zero"), pr.messages_eval(F.lit("T")).alias("few"),
        pr.messages_worker(F.lit("T")).alias("worker"), pr.messages_judge(F.lit("T"), F.lit("fraud"), F.lit("A")).alias("judge"),
    ).first()
    assert [m.role for m in one.zero] == ["system", "user"]
    assert [m.role for m in one.few] == ["system", "user", "assistant", "user", "assistant", "user"] == [m.role for m in one.worker]
    assert one.few[-1].content == "T"
    assert one.judge[1].content == "Transkript: T\nErwartetes Label (Ground Truth): fraud\nKI-Modell Antwort:\nA"
    with pytest.raises(ValueError):
        pr.messages_eval(F.lit("T"), "other")


def test_prompt_plan_is_stable(spark):
    from callsift.plans.generate import plan_samples

    numbers = spark.range(1, 101).withColumnRenamed("id", "number")
    first = plan_samples(numbers).orderBy("id").collect()
    assert first == plan_samples(numbers.repartition(7)).orderBy("id").collect()
    assert [r.label for r in first[:2]] == ["fraud", "legitimate"] and first[0].id == "doc-00001"
    assert {r.max_tokens for r in first} == {600, 1000, 1600}
    assert all(("BETRUGSGESPRAECH" in r.prompt) == (r.label == "fraud") for r in first)
