"""Input frames of the registered queries, each with the SQL that builds the same rows.

The tables stand in for calls: documents are transcripts, labels are gold, conversations are turns. Where an operator
needs input that no table has (model answers, judge replies), it is derived from every row of these tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions import draws
from callsift.functions.answers import parse_contains
from callsift.functions.text import WHITESPACE
from callsift.operators.noise import inject_noise


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


# --- SQL helpers --------------------------------------------------------------------------------


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip_sql(x: str) -> str:
    return f"trim({x}, {lit(WHITESPACE)})"


def replace_sql(x: str, pairs: list[tuple[str, str]]) -> str:
    for old, new in pairs:
        x = f"replace({x}, {lit(old)}, {lit(new)})"
    return x


def mask_sql(x: str) -> str:
    for pattern, mark in V.MASK_RULES:
        flags, body = pattern[2:].split(")", 1)
        x = f"regexp_replace({x}, {lit(body)}, {lit(mark)}, {lit('gi' if 'i' in flags else 'g')})"
    return x


def digest_sql(key: str, seed: int = V.SPLIT_SEED) -> str:
    return f"md5('{seed}:' || {key})"


def number_sql(digest: str, part: int) -> str:
    return f"CAST('0x' || substr({digest}, {8 * part + 1}, 8) AS BIGINT)"


def uniform_sql(digest: str, part: int = 0) -> str:
    return f"({number_sql(digest, part)} / 4294967296.0)"


def pick_sql(digest: str, part: int, size: int) -> str:
    return f"({number_sql(digest, part)} % {size})"


def choose_sql(values: list, index: str) -> str:
    shown = ", ".join(lit(v) if isinstance(v, str) else str(v) for v in values)
    return f"([{shown}])[{index} + 1]"


# --- frames ---------------------------------------------------------------------------------


def calls(spark: SparkSession, folder: str) -> DataFrame:
    """(call_id, text)"""
    return documents(spark, folder).select(F.format_string("doc-%05d", "doc_id").alias("call_id"), "text")


CALLS = "calls AS (SELECT printf('doc-%05d', doc_id) AS call_id, text FROM documents)"


def gold(spark: SparkSession, folder: str) -> DataFrame:
    """(id, label)"""
    return table(spark, folder, "labels").select(
        F.format_string("doc-%05d", "doc_id").alias("id"),
        F.when(F.col("toxic") == 1, "fraud").otherwise("legitimate").alias("label"),
    )


GOLD = (
    "gold AS (SELECT printf('doc-%05d', doc_id) AS id, "
    "CASE WHEN toxic = 1 THEN 'fraud' ELSE 'legitimate' END AS label FROM labels)"
)


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    """(id, input, output) of documents with gold."""
    docs = calls(spark, folder).withColumnRenamed("call_id", "id")
    return docs.join(gold(spark, folder), "id").select("id", F.col("text").alias("input"), F.col("label").alias("output"))


PAIRS = (
    f"{CALLS}, {GOLD}, pairs AS (SELECT gold.id, calls.text AS input, gold.label AS output "
    "FROM calls JOIN gold ON calls.call_id = gold.id)"
)


def answers(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, input, label, output, answer): ten kinds of model answers, one of them a failed call (null)."""
    docs = documents(spark, folder).select("doc_id", "text", "lang", "n_chars")
    toxic = table(spark, folder, "labels").select("doc_id", "toxic")
    label = F.when(F.col("toxic") == 1, "fraud").otherwise("legitimate")
    german = F.when(F.col("toxic") == 1, "Betrug").otherwise("Kein Betrug")
    kind = F.col("n_chars") % 10
    answer = (
        F.when(kind == 0, F.lit("Result: fraud"))
        .when(kind == 1, F.lit("result: LEGITIMATE"))
        .when(kind == 2, F.lit("\n Fraudulent behaviour is likely\t"))
        .when(kind == 3, F.lit("This looks illegitimate"))
        .when(kind == 4, F.lit("not fraud but legitimate"))
        .when(kind == 5, F.lit("legitimate rather than fraud"))
        .when(kind == 6, F.col("text"))
        .when(kind == 7, F.lit(""))
        .when(kind == 8, F.concat(F.lit("Result: "), label, F.lit("\n### Response:\n"), F.col("text")))
    )
    output = F.when(F.col("lang") == "de", german).otherwise(F.concat(F.lit(" "), F.upper(label), F.lit("\n")))
    return docs.join(toxic, "doc_id", "left").select(
        "doc_id", F.col("text").alias("input"), label.alias("label"), output.alias("output"), answer.alias("answer")
    )


ANSWERS = """answers AS (
  SELECT d.doc_id, d.text AS input, l.label,
    CASE WHEN lang = 'de' THEN CASE WHEN label = 'fraud' THEN 'Betrug' ELSE 'Kein Betrug' END
      ELSE ' ' || upper(label) || chr(10) END AS output,
    CASE n_chars % 10
      WHEN 0 THEN 'Result: fraud'
      WHEN 1 THEN 'result: LEGITIMATE'
      WHEN 2 THEN chr(10) || ' Fraudulent behaviour is likely' || chr(9)
      WHEN 3 THEN 'This looks illegitimate'
      WHEN 4 THEN 'not fraud but legitimate'
      WHEN 5 THEN 'legitimate rather than fraud'
      WHEN 6 THEN text
      WHEN 7 THEN ''
      WHEN 8 THEN 'Result: ' || label || chr(10) || '### Response:' || chr(10) || text END AS answer
  FROM documents d
  JOIN (SELECT d2.doc_id, CASE WHEN toxic = 1 THEN 'fraud' ELSE 'legitimate' END AS label
        FROM documents d2 LEFT JOIN labels ON d2.doc_id = labels.doc_id) l ON d.doc_id = l.doc_id)"""


def only_sql(x: str, legit: str, fraud: str, fallback: str) -> str:
    return (
        f"CASE WHEN contains({x}, '{legit}') AND NOT contains({x}, 'fraud') THEN 'legitimate' "
        f"WHEN contains({x}, '{fraud}') AND NOT contains({x}, 'legitimate') THEN 'fraud' "
        f"ELSE coalesce(nullif(regexp_extract({x}, '\\b(fraud|legitimate)\\b', 1), ''), {fallback}) END"
    )


TIDY = f"lower({strip_sql('answer')})"
PARSE_CONTAINS = f"CASE WHEN answer IS NOT NULL THEN {only_sql(TIDY, 'legitimate', 'fraud', lit('unknown'))} END"


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, gold, pred): labels against the labels parsed from the answers."""
    return answers(spark, folder).select(
        "doc_id", F.col("label").alias("gold"), parse_contains(F.col("answer")).alias("pred")
    )


SCORED = f"{ANSWERS}, scored AS (SELECT doc_id, label AS gold, {PARSE_CONTAINS} AS pred FROM answers)"


def noisy_sql() -> str:
    """The noisy rows, as CTEs ending in `noisy`."""
    pii = choose_sql(V.PII_SAMPLES, pick_sql("h", 1, len(V.PII_SAMPLES)))
    junk = choose_sql(V.GARBAGE_SNIPPETS, pick_sql("h", 1, len(V.GARBAGE_SNIPPETS)))
    return f"""{CALLS}, drawn AS (
  SELECT call_id, text, h, {uniform_sql('h')} AS u FROM (SELECT *, {digest_sql('call_id')} AS h FROM calls)
  WHERE length(text) > 0), branched AS (
  SELECT *, CASE WHEN u < 0.08::DOUBLE THEN 'duplicate' WHEN u < 0.08::DOUBLE + 0.07::DOUBLE THEN 'pii'
    WHEN u < 0.08::DOUBLE + 0.07::DOUBLE + 0.05::DOUBLE THEN 'garbage'
    WHEN u < 0.08::DOUBLE + 0.07::DOUBLE + 0.05::DOUBLE + 0.03::DOUBLE THEN 'encoding' ELSE 'clean' END AS branch
  FROM drawn), noisy AS (
  SELECT call_id, CASE branch WHEN 'pii' THEN text || chr(10) || 'Anrufer: ' || {pii} WHEN 'garbage' THEN {junk}
      WHEN 'encoding' THEN {replace_sql('text', V.BROKEN_UMLAUTS)} ELSE text END AS text,
    branch IN ('duplicate', 'clean') AS is_clean,
    CASE branch WHEN 'pii' THEN 'pii_injection' WHEN 'garbage' THEN 'garbage_text' WHEN 'encoding' THEN 'encoding_error'
      ELSE 'none' END AS noise_type
  FROM branched
  UNION ALL
  SELECT call_id || '_DUP', text, false, 'exact_duplicate' FROM branched WHERE branch = 'duplicate')"""


def samples(spark: SparkSession, folder: str) -> DataFrame:
    """(id, label, attempt, raw, verdict): three generated answers per document in different shapes, with verdicts."""
    docs = documents(spark, folder).select("doc_id", "text", "n_chars")
    tries = docs.withColumn("attempt", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    kind = (F.col("n_chars") + F.col("attempt")) % 5
    body = F.to_json(F.struct("text"))
    fenced = F.concat(F.lit("```json\n"), body, F.lit("\n```"))
    raw = (
        F.when(kind == 0, body).when(kind == 1, fenced).when(kind == 2, F.col("text"))
        .when(kind == 3, F.lit('{"id": "x"}')).otherwise(F.lit('{"text": 7}'))
    )
    value = ((F.col("n_chars") + 2 * F.col("attempt")) % 6).cast("string")
    verdict = F.concat(
        F.lit('```json\n{"score": '), F.when(kind == 1, F.concat(F.lit('"'), value, F.lit('"'))).otherwise(value), F.lit("}\n```")
    )
    verdict = F.when(kind == 2, F.lit("no score")).otherwise(verdict)
    return tries.select(
        F.format_string("doc-%05d", "doc_id").alias("id"), "attempt", raw.alias("raw"), verdict.alias("verdict")
    )


SAMPLES = """samples AS (
  SELECT printf('doc-%05d', doc_id) AS id, attempt, text, kind,
    CASE kind WHEN 0 THEN to_json({'text': text})::VARCHAR
      WHEN 1 THEN '```json' || chr(10) || to_json({'text': text})::VARCHAR || chr(10) || '```'
      WHEN 2 THEN text WHEN 3 THEN '{"id": "x"}' ELSE '{"text": 7}' END AS raw,
    CASE WHEN kind = 2 THEN 0 ELSE CAST(value AS INTEGER) END AS score
  FROM (SELECT *, (n_chars + attempt) % 5 AS kind, (n_chars + 2 * attempt) % 6 AS value
        FROM documents, (SELECT unnest([0, 1, 2])::INTEGER AS attempt)))"""


def noisy(spark: SparkSession, folder: str) -> DataFrame:
    return inject_noise(calls(spark, folder))
