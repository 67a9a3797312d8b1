"""Queries over prompts, raw answers, model calls, files and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions import answers as an, draws, prompts as pr, text as tx
from callsift.operators import metrics, scoring
from callsift.plans import evaluate as ev, generate as gen
from callsift.session import fresh_path, settle
from callsift.sources import jsonl, reports
from callsift.streaming import live
from callsift.workload import frames as fr
from callsift.workload.labelling import report_sql, run_metrics_sql


def _prompt(build, name: str = "prompt"):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return fr.pairs(spark, folder).select("id", build(F.col("input"), F.col("output")).alias(name))

    return query


def _chat(build):
    """Messages as one text, so that both engines compare plain strings."""

    def flat(text: Column, output: Column) -> Column:
        return F.array_join(F.transform(build(text, output), lambda m: F.concat(m["role"], F.lit("> "), m["content"])), "\n")

    return _prompt(flat, "messages")


def _training_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = fr.pairs(spark, folder)
    return rows.select("id", pr.format_training_text(rows.columns, "</s>").alias("prompt"))


def _text_training_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = fr.calls(spark, folder)
    return rows.select("call_id", pr.format_training_text(rows.columns, "</s>").alias("prompt"))


def is_fraud_by_parity(spark: SparkSession, folder: str) -> DataFrame:
    return fr.table(spark, folder, "documents").select("doc_id", pr.label_by_parity(F.col("doc_id")).alias("label"))


def prompt_plan(spark: SparkSession, folder: str) -> DataFrame:
    return gen.plan_samples(fr.table(spark, folder, "documents"), "doc_id")


def _enveloped(spark: SparkSession, folder: str) -> DataFrame:
    """Answers in a chat, a completion and a plain object; a failed call is an error object."""
    content = F.struct(F.struct(F.col("answer").alias("content")).alias("message"))
    wrap = lambda choice: F.to_json(F.struct(F.array(choice).alias("choices")))
    failed = F.lit('{"error": "busy"}')
    return fr.answers(spark, folder).select(
        "doc_id",
        F.when(F.col("answer").isNull(), failed).otherwise(wrap(content)).alias("chat"),
        F.when(F.col("answer").isNull(), failed).otherwise(wrap(F.struct(F.col("answer").alias("text")))).alias("completion"),
        F.when(F.col("answer").isNull(), failed)
        .when(F.col("label") == "fraud", F.to_json(F.struct(F.col("answer").alias("content"))))
        .otherwise(F.concat(F.lit("plain: "), "answer"))
        .alias("guarded"),
    )


def _unwrapped(build, column: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _enveloped(spark, folder).select("doc_id", build(F.col(column)).alias("answer"))

    return query


def clean_answer(spark: SparkSession, folder: str) -> DataFrame:
    return fr.samples(spark, folder).select("id", "attempt", an.clean_answer(F.col("raw")).alias("text"))


def clean_answer_plain(spark: SparkSession, folder: str) -> DataFrame:
    return fr.samples(spark, folder).select("id", "attempt", an.clean_answer(F.col("raw"), False).alias("text"))


def strip_fence(spark: SparkSession, folder: str) -> DataFrame:
    """A fenced document followed by a second one that only has a closing fence."""
    raw = F.concat(F.lit("```json\n"), "text", F.lit("\n```\n"), "text", F.lit("\n```"))
    return fr.documents(spark, folder).select("doc_id", an.strip_fence(raw).alias("text"))


def double_bad_backslashes(spark: SparkSession, folder: str) -> DataFrame:
    """Words end with a bad escape, sentences with a good one."""
    raw = F.replace(F.replace("text", F.lit(" "), F.lit("\\d ")), F.lit("."), F.lit("\\n"))
    return fr.documents(spark, folder).select("doc_id", an.double_bad_backslashes(raw).alias("text"))


def temperature(spark: SparkSession, folder: str) -> DataFrame:
    draw = draws.digest(V.SPLIT_SEED, F.col("doc_id"), F.lit(0))
    return fr.table(spark, folder, "documents").select("doc_id", draws.temperature(draw).alias("temperature"))


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    return fr.samples(spark, folder).select("id", "attempt", an.judge_score(F.col("verdict")).alias("score"))


def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.quality_gate(_judged(spark, folder))


def first_accepted_attempt(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.first_accepted_attempt(_judged(spark, folder))


# --- model calls: small deterministic stand-ins for a model ----------------------------------


def _word_model():
    """Answers with a Result line: fraud when the last message names an odd number of characters."""

    def ask(prompts: Sequence) -> list[str]:
        texts = [p[-1]["content"] if isinstance(p, list) else p for p in prompts]
        return [f" Result: {'fraud' if len(t) % 2 else 'legitimate'}\n" for t in texts]

    return ask


def _strict_judge():
    def ask(prompts: Sequence) -> list[str]:
        found = []
        for messages in prompts:
            gold, answer = messages[-1]["content"].rsplit("\n" + V.JUDGE_GOLD, 1)[1].split("\n", 1)
            found.append("Score: PASS" if f"Result: {gold}" in answer else "Score: FAIL\nBegründung: anders")
        return found

    return ask


def _writer_model():
    """Writes the prompt back as a JSON transcript, with a tail that depends on the temperature, so that a retry differs."""

    def ask(requests: Sequence) -> list[str]:
        import json

        tail = lambda r: "|" + "~" * (round(r["temperature"] * 100) % 6)
        return ["```json\n" + json.dumps({"text": r["messages"][-1]["content"] + tail(r)}) + "\n```" for r in requests]

    return ask


def _score_model():
    """Scores a sample by the length of its prompt: 0 to 5."""

    def ask(prompts: Sequence) -> list[str]:
        return [f'{{"score": {len(p[-1]["content"]) % 6}}}' for p in prompts]

    return ask


def score_with(spark: SparkSession, folder: str) -> DataFrame:
    asked = fr.pairs(spark, folder).select("id", pr.prompt_question(F.col("input")).alias("prompt"))
    return scoring.score_with(asked, _word_model).select("id", "answer", "error")


def evaluate_modes(spark: SparkSession, folder: str) -> DataFrame:
    found = ev.evaluate(fr.pairs(spark, folder), _word_model)
    return found.withColumns({c: F.round(c, 6) for c in found.columns if c != "mode"})


def judge_flow(spark: SparkSession, folder: str) -> DataFrame:
    rows = fr.pairs(spark, folder)
    return ev.judge(rows, _word_model, _strict_judge, ["id"]).drop("error")


def infer(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, and beside each Spanish one a row without text."""
    docs = fr.documents(spark, folder)
    bare = docs.where("lang = 'es'").select((-F.col("doc_id") - 1).alias("doc_id"), F.lit(None).cast("string").alias("text"))
    found = ev.infer(docs.select("doc_id", "text").unionByName(bare), _word_model)
    return found.select("doc_id", "label", "confidence", "prompt_length", "error")


def generate_flow(spark: SparkSession, folder: str) -> DataFrame:
    plan = gen.plan_samples(fr.table(spark, folder, "documents"), "doc_id")
    return gen.generate(plan, _writer_model, _score_model, "example")


# --- files ------------------------------------------------------------------------------------


def _call_lines(spark: SparkSession, folder: str) -> str:
    """Documents as JSON lines: French ones also cut off (bad JSON), German ones followed by a blank line."""
    rows = fr.documents(spark, folder)
    line = F.to_json(F.struct(F.format_string("doc-%05d", "doc_id").alias("call_id"), "text"))
    value = (
        F.when(F.col("lang") == "fr", F.expr("concat(line, '\n', substr(line, 1, length(line) - 1))"))
        .when(F.col("lang") == "de", F.concat("line", F.lit("\n   ")))
        .otherwise(F.col("line"))
    )
    path = fresh_path(spark, "lines")
    rows.withColumn("line", line).select(value.alias("value")).write.text(path)
    return path


def read_jsonl_lenient(spark: SparkSession, folder: str) -> DataFrame:
    good, _ = jsonl.read_jsonl_lenient(spark, _call_lines(spark, folder))
    return good.select("call_id", "text")


def read_jsonl_lenient_bad(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = jsonl.read_jsonl_lenient(spark, _call_lines(spark, folder))
    return bad.select(F.length("value").alias("length"), F.md5("value").alias("digest"))


def validate_jsonl(spark: SparkSession, folder: str) -> DataFrame:
    lines = spark.read.text(_call_lines(spark, folder))
    return jsonl.validate_jsonl(lines.where(~tx.is_blank(F.col("value"))))


def _good_lines(spark: SparkSession, folder: str) -> str:
    path = fresh_path(spark, "calls")
    jsonl.write_jsonl(fr.noisy(spark, folder), path)
    return path


def read_jsonl_strict(spark: SparkSession, folder: str) -> DataFrame:
    rows, found = jsonl.read_jsonl_strict(spark, _good_lines(spark, folder))
    return rows.select("call_id", "text", F.lit(found).cast("bigint").alias("records"))


def read_jsonl_plain(spark: SparkSession, folder: str) -> DataFrame:
    return jsonl.read_jsonl_plain(spark, _good_lines(spark, folder)).drop("id")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    rows = jsonl.read_documents(spark, _good_lines(spark, folder))
    return rows.select("call_id", "text", "is_clean", "noise_type", F.endswith("file_name", F.lit(".json")).alias("named"))


def write_curated(spark: SparkSession, folder: str) -> DataFrame:
    """Written twice: the second run replaces the first."""
    path = fresh_path(spark, "curated")
    jsonl.write_curated(fr.calls(spark, folder), path)
    jsonl.write_curated(fr.noisy(spark, folder), path)
    return jsonl.read_documents(spark, path).select("call_id", "text", "is_clean", "noise_type")


def append_pair_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Both appended data sets, joined back."""
    rows = fr.pairs(spark, folder).select("id", F.col("input").alias("text"), F.col("output").alias("label"), F.lit(4).alias("score"))
    texts, gold = fresh_path(spark, "texts"), fresh_path(spark, "gold")
    reports.append_pair_sink(rows, texts, gold, "example")
    left = spark.read.schema("id STRING, text STRING, source STRING").json(texts)
    return left.join(spark.read.schema("id STRING, label STRING, score INT").json(gold), "id")


def write_report_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "report")
    rows = fr.scored(spark, folder).join(fr.answers(spark, folder).select("doc_id", "input"), "doc_id")
    passed = F.when(F.col("gold") == F.col("pred"), "PASS").otherwise("FAIL")
    report = rows.where("pred is not null").select(
        F.col("doc_id").alias("id"), F.col("gold").alias("true_label"), F.col("pred").alias("model_prediction"),
        passed.alias("judge_score"), F.col("input").alias("model_output"),
    )
    reports.write_report_csv(report, path)
    shape = "id BIGINT, true_label STRING, model_prediction STRING, judge_score STRING, model_output STRING"
    return spark.read.schema(shape).option("header", True).option("escape", '"').csv(path)


def report_extract(spark: SparkSession, folder: str) -> DataFrame:
    return reports.report_extract(write_report_csv(spark, folder))


def write_predictions(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "predictions")
    rows = fr.answers(spark, folder)
    reports.write_predictions(rows.select("doc_id", "input", "output", F.col("answer").alias("prediction")), path)
    return spark.read.schema("doc_id BIGINT, input STRING, output STRING, prediction STRING").json(path)


def log_run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "metrics")
    found = metrics.run_metrics(fr.scored(spark, folder))
    for run in ("first", "second"):
        reports.log_run_metrics(found, run, {"evaluation_mode": run}, path)
    reports.log_run_metrics(found, "second", {"evaluation_mode": "second"}, path)  # again under one id: changes nothing
    logged = spark.read.schema("params map<string,string>, metric string, value double, run string").parquet(path)
    return logged.select("run", F.col("params")["evaluation_mode"].alias("mode"), "metric", F.round("value", 6).alias("value"))


def write_eval_table(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "eval")
    rows = fr.scored(spark, folder).join(fr.answers(spark, folder).select("doc_id", "input"), "doc_id")
    reports.write_eval_table(rows, path)
    return spark.read.parquet(path)


# --- streams ------------------------------------------------------------------------------------

_EVENTS = "event_id BIGINT, event_type STRING, value DOUBLE, props STRING"
_DOCUMENTS = "doc_id BIGINT, text STRING, lang STRING"


def stream_fraud_counter(spark: SparkSession, folder: str) -> DataFrame:
    """Events as arriving calls: errors are answered `fraud`, purchases `legitimate`, the rest not at all."""
    events = live.arriving(spark, f"{folder}/{{events}}.parquet", _EVENTS)
    said = F.when(F.col("event_type") == "error", "Result: fraud").when(F.col("event_type") == "purchase", "Result: legitimate")
    labelled = events.select(an.parse_result_tag(F.coalesce(said, "event_type")).alias("label"))
    table = fresh_path(spark, "counts")
    live.stream_fraud_counter(labelled, table, fresh_path(spark, "counts-state")).awaitTermination()
    return live.current_counts(spark, table)


def stream_curate_rows(spark: SparkSession, folder: str) -> DataFrame:
    target = fresh_path(spark, "stream")
    docs = live.arriving(spark, f"{folder}/{{documents}}.parquet", _DOCUMENTS).select("doc_id", "text")
    live.stream_curate_rows(docs, target, fresh_path(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(target)


QUERIES = {
    "prompt_instruction": _prompt(lambda t, o: pr.prompt_instruction(t)),
    "prompt_question": _prompt(lambda t, o: pr.prompt_question(t)),
    "prompt_concat": _prompt(pr.prompt_concat),
    "prompt_inference": _prompt(lambda t, o: pr.prompt_inference(t)),
    "prompt_quality": _prompt(lambda t, o: pr.prompt_quality(t)),
    "format_training_text": _training_text,
    "format_training_text_first_column": _text_training_text,
    "messages_baseline": _chat(lambda t, o: pr.messages_baseline(t)),
    "messages_eval_zero_shot": _chat(lambda t, o: pr.messages_eval(t, "zero-shot")),
    "messages_eval_few_shot": _chat(lambda t, o: pr.messages_eval(t, "few-shot")),
    "messages_eval_word": _chat(lambda t, o: pr.messages_eval(t, "few-shot", "word")),
    "messages_worker": _chat(lambda t, o: pr.messages_worker(t)),
    "messages_judge": _chat(lambda t, o: pr.messages_judge(t, o, F.upper(o))),
    "is_fraud_by_parity": is_fraud_by_parity,
    "prompt_plan": prompt_plan,
    "unwrap_chat": _unwrapped(an.unwrap_chat, "chat"),
    "unwrap_completion": _unwrapped(an.unwrap_completion, "completion"),
    "unwrap_guarded": _unwrapped(an.unwrap_guarded, "guarded"),
    "clean_answer": clean_answer,
    "clean_answer_plain": clean_answer_plain,
    "strip_fence": strip_fence,
    "double_bad_backslashes": double_bad_backslashes,
    "temperature": temperature,
    "judge_score": _judged,
    "quality_gate": quality_gate,
    "first_accepted_attempt": first_accepted_attempt,
    "score_with": score_with,
    "evaluate_modes": evaluate_modes,
    "judge_flow": judge_flow,
    "infer": infer,
    "generate_flow": generate_flow,
    "read_jsonl_lenient": read_jsonl_lenient,
    "read_jsonl_lenient_bad": read_jsonl_lenient_bad,
    "validate_jsonl": validate_jsonl,
    "read_jsonl_strict": read_jsonl_strict,
    "read_jsonl_plain": read_jsonl_plain,
    "read_documents": read_documents,
    "write_curated": write_curated,
    "append_pair_sink": append_pair_sink,
    "write_report_csv": write_report_csv,
    "report_extract": report_extract,
    "write_predictions": write_predictions,
    "log_run_metrics": log_run_metrics,
    "write_eval_table": write_eval_table,
    "stream_fraud_counter": stream_fraud_counter,
    "stream_curate_rows": stream_curate_rows,
}

# --- SQL ------------------------------------------------------------------------------------

_PAIRS, _ANSWERS, _SCORED = f"WITH {fr.PAIRS}", f"WITH {fr.ANSWERS}", f"WITH {fr.SCORED}"
_NOISY, _SAMPLES = f"WITH {fr.noisy_sql()}", f"WITH {fr.SAMPLES}"


def _prompt_sql(expression: str, name: str = "prompt") -> str:
    return f"{_PAIRS} SELECT id, {expression} AS {name} FROM pairs"


def _chat_sql(system: str, examples: list[tuple[str, str]], last: str) -> str:
    head = "system> " + system + "\n" + "".join(f"user> {q}\nassistant> {a}\n" for q, a in examples) + "user> "
    return _prompt_sql(f"{fr.lit(head)} || {last}", "messages")


def _plan_sql() -> str:
    h = "h"
    name = fr.choose_sql(V.CUSTOMER_NAMES, fr.pick_sql(h, 0, 20))
    tone = fr.choose_sql(V.TONES, fr.pick_sql(h, 1, 6))
    size = fr.pick_sql(h, 2, 3)
    length = fr.choose_sql([t for t, _ in V.LENGTHS], size)
    scene = fr.pick_sql(h, 3, 10)

    def filled(template: str, scenarios: list[str]) -> str:
        values = iter([name, fr.choose_sql(scenarios, scene), tone, length])
        parts = template.split("%s")
        return " || ".join([fr.lit(parts[0])] + [f"{next(values)} || {fr.lit(p)}" for p in parts[1:]])

    return (
        "SELECT printf('doc-%05d', doc_id) AS id, CASE WHEN doc_id % 2 <> 0 THEN 'fraud' ELSE 'legitimate' END AS label, "
        f"{fr.choose_sql([c for _, c in V.LENGTHS], size)} AS max_tokens, CASE WHEN doc_id % 2 <> 0 "
        f"THEN {filled(V.FRAUD_PLAN, V.FRAUD_SCENARIOS)} ELSE {filled(V.LEGITIMATE_PLAN, V.LEGITIMATE_SCENARIOS)} END AS prompt "
        f"FROM (SELECT doc_id, {fr.digest_sql('doc_id')} AS h FROM documents)"
    )


_SAID = "CASE WHEN length({x}) % 2 = 1 THEN 'fraud' ELSE 'legitimate' END"
_CLEAN_SQL = "CASE kind WHEN 0 THEN text WHEN 1 THEN text WHEN 2 THEN replace({strip}, '\\', '/') WHEN 3 THEN {missing} END"
_ANSWER_STRIPPED = fr.strip_sql("answer")
_MASKED = fr.mask_sql(fr.replace_sql("text", tx.broken_pairs()))
_QUALITY_LENGTH = len(V.QUALITY_HEAD + V.QUALITY_TAIL)

SQL = {
    "prompt_instruction": _prompt_sql(f"{fr.lit(V.INSTRUCTION_HEAD)} || input || {fr.lit(chr(10) * 2 + V.RESPONSE_HEAD)}"),
    "prompt_question": _prompt_sql(f"{fr.lit(V.QUESTION_HEAD)} || input || {fr.lit(V.QUESTION_TAIL)}"),
    "prompt_concat": _prompt_sql("input || output"),
    "prompt_inference": _prompt_sql(f"{fr.lit(V.INFERENCE_HEAD)} || input"),
    "prompt_quality": _prompt_sql(f"{fr.lit(V.QUALITY_HEAD)} || input || {fr.lit(V.QUALITY_TAIL)}"),
    "format_training_text": _prompt_sql(
        f"{fr.lit(V.INSTRUCTION_HEAD)} || input || {fr.lit(chr(10) * 2 + V.RESPONSE_HEAD)} || output || '</s>'"
    ),
    "format_training_text_first_column": f"WITH {fr.CALLS} SELECT call_id, text || '</s>' AS prompt FROM calls",
    "messages_baseline": _chat_sql(V.BASELINE_SYSTEM, [], "input"),
    "messages_eval_zero_shot": _chat_sql(V.EVAL_STYLES["reasoned"][0], [], "input"),
    "messages_eval_few_shot": _chat_sql(*V.EVAL_STYLES["reasoned"], "input"),
    "messages_eval_word": _chat_sql(*V.EVAL_STYLES["word"], "input"),
    "messages_worker": _chat_sql(V.WORKER_SYSTEM, V.WORKER_EXAMPLES, "input"),
    "messages_judge": _chat_sql(
        V.JUDGE_SYSTEM, [],
        f"{fr.lit(V.JUDGE_CALL)} || input || chr(10) || {fr.lit(V.JUDGE_GOLD)} || output || chr(10) || "
        f"{fr.lit(V.JUDGE_ANSWER)} || chr(10) || upper(output)",
    ),
    "is_fraud_by_parity": "SELECT doc_id, CASE WHEN doc_id % 2 <> 0 THEN 'fraud' ELSE 'legitimate' END AS label FROM documents",
    "prompt_plan": _plan_sql(),
    "unwrap_chat": f"{_ANSWERS} SELECT doc_id, {_ANSWER_STRIPPED} AS answer FROM answers",
    "unwrap_completion": f"{_ANSWERS} SELECT doc_id, {_ANSWER_STRIPPED} AS answer FROM answers",
    "unwrap_guarded": f"{_ANSWERS} SELECT doc_id, CASE WHEN answer IS NULL THEN '{{\"error\": \"busy\"}}' WHEN label = 'fraud' "
    "THEN answer ELSE 'plain: ' || answer END AS answer FROM answers",
    "clean_answer": f"{_SAMPLES} SELECT id, attempt, {_CLEAN_SQL.format(strip=fr.strip_sql('text'), missing='raw')} AS text FROM samples",
    "clean_answer_plain": f"{_SAMPLES} SELECT id, attempt, {_CLEAN_SQL.format(strip=fr.strip_sql('text'), missing=fr.lit(''))} AS text FROM samples",
    "strip_fence": "SELECT doc_id, text || chr(10) || text AS text FROM documents",
    "double_bad_backslashes": "SELECT doc_id, replace(replace(text, ' ', '\\\\d '), '.', '\\n') AS text FROM documents",
    "temperature": f"SELECT doc_id, round(0.7::DOUBLE + {fr.uniform_sql('h')} * 0.25::DOUBLE, 2) AS temperature "
    f"FROM (SELECT doc_id, {fr.digest_sql(chr(40) + 'doc_id || chr(58) || 0' + chr(41))} AS h FROM documents)",
    "judge_score": f"{_SAMPLES} SELECT id, attempt, score FROM samples",
    "quality_gate": f"{_SAMPLES} SELECT id, attempt, score FROM samples WHERE score >= 4",
    "first_accepted_attempt": f"{_SAMPLES} SELECT id, min(attempt) AS attempt, arg_min(score, attempt) AS score FROM samples "
    "WHERE score >= 4 GROUP BY id",
    "score_with": f"{_PAIRS} SELECT id, ' Result: ' || {_SAID.format(x=f'({fr.lit(V.QUESTION_HEAD)} || input || {fr.lit(V.QUESTION_TAIL)})')} "
    "|| chr(10) AS answer, NULL::VARCHAR AS error FROM pairs",
    "evaluate_modes": f"""{_PAIRS}, runs AS (SELECT mode, output AS gold, {_SAID.format(x='input')} AS pred FROM pairs,
  (SELECT unnest(['zero-shot', 'few-shot']) AS mode)), {report_sql('runs', 'mode')} {run_metrics_sql('mode')}""",
    "log_run_metrics": f"""{_SCORED}, one AS (SELECT *, 1 AS g FROM scored), {report_sql('one', 'g')},
  found AS ({run_metrics_sql('g')}), long AS (UNPIVOT (SELECT * EXCLUDE (g) FROM found) ON * INTO NAME metric VALUE value)
  SELECT run, run AS mode, metric, value FROM long, (SELECT unnest(['first', 'second']) AS run)""",
    "judge_flow": f"{_PAIRS} SELECT row_number() OVER (ORDER BY id) AS id, output AS true_label, p AS model_prediction, CASE WHEN p = output THEN 'PASS' ELSE 'FAIL' END "
    f"AS judge_score, 'Result: ' || p AS model_output FROM (SELECT *, {_SAID.format(x='input')} AS p FROM pairs)",
    "infer": f"SELECT doc_id, CASE WHEN n % 2 = 1 THEN 'fraud' ELSE 'legit' END AS label, 1.0::DOUBLE AS confidence, "
    f"n::INTEGER AS prompt_length, NULL AS error FROM (SELECT *, length({fr.lit(V.INFERENCE_HEAD)} || text) AS n FROM documents) "
    f"UNION ALL SELECT -doc_id - 1, NULL, NULL, NULL, {fr.lit(V.BLANK_INPUT_ERROR)} FROM documents WHERE lang = 'es'",
    "generate_flow": f"""WITH planned AS ({_plan_sql()}), tries AS (
      SELECT id, label, prompt, attempt, round(0.7::DOUBLE + {fr.uniform_sql('d')} * 0.25::DOUBLE, 2) AS warmth
      FROM (SELECT *, {fr.digest_sql("(id || ':' || attempt)")} AS d FROM planned, (SELECT unnest([0, 1, 2])::INTEGER AS attempt))),
    said AS (SELECT id, label, attempt, prompt || '|' || repeat('~', round(warmth * 100)::INTEGER % 6) AS text FROM tries),
    scored AS (SELECT *, (length(text) + {_QUALITY_LENGTH}) % 6 AS s FROM said),
    taken AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY attempt) AS place FROM scored WHERE s >= 4)
    SELECT id, text, label, s::INTEGER AS score, attempt FROM taken WHERE place = 1""",
    "read_jsonl_lenient": f"SELECT printf('doc-%05d', doc_id) AS call_id, text FROM documents",
    "read_jsonl_lenient_bad": "SELECT (length(line) - 1)::INTEGER AS length, md5(substr(line, 1, length(line) - 1)) AS digest FROM (SELECT lang, "
    "'{\"call_id\":\"' || printf('doc-%05d', doc_id) || '\",\"text\":' || to_json(text)::VARCHAR || '}' AS line FROM documents) "
    "WHERE lang = 'fr'",
    "validate_jsonl": "SELECT count(*) + count_if(lang = 'fr') AS total, count_if(lang = 'fr') AS bad_json, 0::BIGINT AS missing_key FROM documents",
    "read_jsonl_strict": f"{_NOISY} SELECT call_id, text, (SELECT count(*) FROM noisy) AS records FROM noisy",
    "read_jsonl_plain": f"{_NOISY} SELECT * FROM noisy",
    "read_documents": f"{_NOISY} SELECT *, true AS named FROM noisy",
    "write_curated": f"{_NOISY} SELECT * FROM noisy",
    "append_pair_sink": f"{_PAIRS} SELECT id, input AS text, 'example' AS source, output AS label, 4 AS score FROM pairs",
    "write_report_csv": f"{_SCORED} SELECT s.doc_id AS id, gold AS true_label, pred AS model_prediction, CASE WHEN gold = pred THEN "
    "'PASS' ELSE 'FAIL' END AS judge_score, replace(input, chr(10), ' ') AS model_output FROM scored s JOIN answers a "
    "ON s.doc_id = a.doc_id WHERE pred IS NOT NULL",
    "report_extract": f"{_SCORED} SELECT doc_id AS id, gold AS true_label, pred AS model_prediction, CASE WHEN gold = pred THEN "
    "'PASS' ELSE 'FAIL' END AS judge_score FROM scored WHERE pred IS NOT NULL",
    "write_predictions": f"{_ANSWERS} SELECT doc_id, input, output, {_ANSWER_STRIPPED} AS prediction FROM answers",
    "write_eval_table": f"{_SCORED} SELECT input AS input_text, gold AS expected_label, pred AS predicted_label FROM scored s "
    "JOIN answers a ON s.doc_id = a.doc_id",
    "stream_fraud_counter": "SELECT CASE event_type WHEN 'error' THEN 'fraud' WHEN 'purchase' THEN 'legitimate' ELSE 'unknown' END "
    "AS label, count(*) AS calls FROM events GROUP BY 1",
    "stream_curate_rows": f"SELECT doc_id, {_MASKED} AS text FROM documents WHERE length({fr.strip_sql(_MASKED)}) >= 50",
}
