import pytest
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions import masking, text as tx


def evaluate(spark, build, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in rows.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]


MASKED = [
    (V.PII_SAMPLES[0],
     "Meine Kreditkartennummer lautet [KREDITKARTE_MASKIERT] mit CVV 892."),
    (V.PII_SAMPLES[1],
     "Sie erreichen mich unter [EMAIL_MASKIERT] oder Mobil: +49 171 1234567."),
    (V.PII_SAMPLES[2],
     "Meine IBAN lautet [IBAN_MASKIERT], Inhaber ist Thomas Müller."),
    (V.PII_SAMPLES[3],
     "Ich wohne in [ADRESSE_MASKIERT]. Geburtsdatum ist der 14.05.1982."),
    (V.PII_SAMPLES[4], V.PII_SAMPLES[4]),
    ("4532-8921-1029-4411-7777", "[KREDITKARTE_MASKIERT]-7777"),
    ("12345678901234567", "12345678901234567"),
    ("Ruf 0171 1234567 an", "Ruf [HANDYNUMMER_MASKIERT] an"),
    ("geboren am 3. märz 1970!", "geboren am [GEBURTSDATUM_MASKIERT]!"),
    ("Kunde 123456789.", "Kunde [KUNDENNUMMER_MASKIERT]."),
    ("MUSTERWEG 3 12345 KÖLN", "[ADRESSE_MASKIERT]"),
    ("a@b.de und 123456789", "[EMAIL_MASKIERT] und [KUNDENNUMMER_MASKIERT]"),
    ("nichts", "nichts"),
    ("", ""),
    (None, None),
]


def test_mask_pii(spark):
    assert evaluate(spark, masking.mask_pii, [a for a, _ in MASKED]) == [b for _, b in MASKED]


def test_mask_gates_change_nothing(spark):
    rows = [a for a, _ in MASKED]
    plain = evaluate(spark, lambda c: masking.apply_rules(c, masking.mask_rules()), rows)
    assert evaluate(spark, masking.mask_pii, rows) == plain
    changed = [None if a is None else a != b for a, b in zip(rows, plain)]
    assert evaluate(spark, masking.is_pii_present, rows) == changed


def test_mask_twice_is_mask_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    once = docs.select(masking.mask_pii(F.col("text")).alias("a"))
    assert once.where(masking.mask_pii(F.col("a")) != F.col("a")).count() == 0


def test_strict_rule_masks_plus_numbers(spark):
    got = evaluate(spark, lambda c: masking.mask_pii(c, strict=True), ["Mobil: +49 171 1234567.", "x0171 1234567"])
    assert got == ["Mobil: [HANDYNUMMER_MASKIERT].", "x0171 1234567"]


def test_unicode_digits_are_digits(spark):
    assert evaluate(spark, masking.mask_pii, ["Nr \u0661\u0662\u0663\u0664\u0665\u0666\u0667\u0668\u0669"]) == ["Nr [KUNDENNUMMER_MASKIERT]"]


def test_compliance(spark):
    texts = [p.upper() if i % 2 else f"Bitte {p}!" for i, p in enumerate(V.PROHIBITED_PHRASES)]
    assert evaluate(spark, masking.compliance_check, [*texts, "a@b.de", "Guten Tag"]) == ["refuse"] * 5 + ["approve"]


def test_strip_matches_python(spark):
    values = [f"{c}x {c}y{c}" for c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2003\u2028\u202f\u205f\u3000\u200b"]
    assert evaluate(spark, tx.strip, values) == [v.strip() for v in values]


def test_score_length_edges(spark):
    values = ["x" * 49, "x" * 50, "\t\xa0" + "ä" * 50 + "\n ", "😀" * 50, " \n", "", None]
    scores = evaluate(spark, tx.score_length, values)
    assert scores == [49, 50, 50, 50, 0, 0, 0]
    assert [s >= V.MIN_LENGTH for s in scores] == [False, True, True, True, False, False, False]


def test_garbage_snippets_are_short(spark):
    assert max(evaluate(spark, tx.score_length, V.GARBAGE_SNIPPETS)) < V.MIN_LENGTH


def test_repair_undoes_broken_umlauts(spark):
    values = ["Grüße aus Köln, schöne Maße", "ÄÖÜ bleiben", "SÃO PAULO", "ohne", None]
    broken = evaluate(spark, tx.break_umlauts, values)
    assert broken[0] == "GrÃ¼Ã\x9fe aus KÃ¶ln, schÃ¶ne MaÃ\x9fe"
    assert evaluate(spark, tx.repair_unicode, broken) == values
    assert evaluate(spark, tx.repair_unicode, values) == values


def test_repair_knows_both_readings_and_extra_pairs(spark):
    assert evaluate(spark, tx.repair_unicode, ["StraÃŸe", "Ã„rger", "Ã\xa0"]) == ["Straße", "Ärger", "à"]
    extra = lambda c: tx.repair_unicode(c, [("â‚¬", "€")])
    assert evaluate(spark, extra, ["5 â‚¬"]) == ["5 €"]


@pytest.mark.parametrize(
    "text, response, flat",
    [
        ("flach", '{"transcript": [{"speaker": "A", "text": "b"}]}', "flach"),
        ("", '{"transcript": [{"speaker": "A", "text": "b"}]}', ""),
        (None, '{"transcript": [{"speaker": "A", "text": "b"}, {"text": "c"}, {"speaker": "D"}]}', "A: b\nUnbekannt: c\nD: "),
        (None, '{"transcript": [{"speaker": null, "text": "b"}]}', "None: b"),
        (None, '{"transcript": []}', ""),
        (None, '{"transcript": null}', ""),
        (None, '{"other": 1}', ""),
        (None, "[1, 2]", ""),
        (None, "{broken", ""),
        (None, "", ""),
        (None, None, ""),
    ],
)
def test_flatten_transcript(spark, text, response, flat):
    rows = spark.createDataFrame([(text, response)], "text string, response string")
    assert rows.select(tx.flatten_transcript(F.col("text"), F.col("response"))).first()[0] == flat


def test_marks(spark):
    assert evaluate(spark, tx.garbage_test, [" ??? ", "N/A", "NULL", "a", "asdfghjkl;", "b"]) == [True] * 5 + [False]
    assert evaluate(spark, tx.mojibake_test, ["schÃ¶n", "spÃ¤t", "fÃ¼r"]) == [True, True, False]
    assert evaluate(spark, tx.pii_keyword_test, ["Kreditkarte", "x IBAN", "DE89", "a@example.de", "iban"]) == [True] * 4 + [False]
    assert evaluate(spark, tx.dup_marker_test, ["doc_DUP", "doc"]) == [True, False]


def test_label_and_key_rules(spark):
    rows = spark.createDataFrame(
        [("c", "i", "fraud", "x"), ("", "i", "", "legitimate"), (None, None, None, "")],
        "call_id string, id string, label string, fraud_type string",
    )
    got = rows.select(tx.document_key(F.col("call_id"), F.col("id")), tx.gold_label(F.col("label"), F.col("fraud_type")))
    assert [tuple(r) for r in got.collect()] == [("c", "fraud"), ("i", "legitimate"), ("", None)]


def test_padded_id(spark):
    assert evaluate(spark, lambda c: tx.padded_id("CALL_", c, 4), [7, 12345], "int") == ["CALL_0007", "CALL_12345"]
