"""Queries over gold labels, splits, parsers and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions import answers as an
from callsift.operators import ids, labels, metrics, scoring, similarity, splits
from callsift.plans.pairs import prepare_pairs
from callsift.session import settle
from callsift.workload import frames as fr


def _repeated_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Each label row twice, the second under the alternate key and sometimes empty; one id is blank."""
    rows = fr.table(spark, folder, "labels")
    name = F.format_string("doc-%05d", "doc_id")
    by_toxic = F.when(F.col("toxic") == 1, "fraud").otherwise("legitimate")
    by_quality = F.when(F.col("quality") == 1, "legitimate").otherwise("")
    first = F.struct(
        name.alias("id"), by_toxic.alias("label"), F.lit(None).cast("string").alias("fraud_type"), F.lit(0).alias("part")
    )
    second = F.struct(
        F.when(F.col("toxic") == 1, "").otherwise(name).alias("id"), F.lit("").alias("label"),
        by_quality.alias("fraud_type"), F.lit(1).alias("part"),
    )
    return rows.select("doc_id", F.inline(F.array(first, second)))


_REPEATED = """repeated AS (
  SELECT doc_id, printf('doc-%05d', doc_id) AS id, CASE WHEN toxic = 1 THEN 'fraud' ELSE 'legitimate' END AS label,
    NULL AS fraud_type, 0 AS part FROM labels
  UNION ALL SELECT doc_id, CASE WHEN toxic = 1 THEN '' ELSE printf('doc-%05d', doc_id) END, '',
    CASE WHEN quality = 1 THEN 'legitimate' ELSE '' END, 1 FROM labels), last AS (
  SELECT id, arg_max(coalesce(nullif(label, ''), nullif(fraud_type, '')), doc_id * 2 + part) AS label
  FROM repeated WHERE id <> '' AND coalesce(nullif(label, ''), nullif(fraud_type, '')) IS NOT NULL GROUP BY id)"""


def gold_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    return labels.gold_last_wins(_repeated_gold(spark, folder), ["doc_id", "part"])


def _keyed_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a call id, except Spanish ones (no id at all) and French ones (id only)."""
    name = F.format_string("doc-%05d", "doc_id")
    return fr.table(spark, folder, "documents").select(
        "doc_id",
        F.when(F.col("lang").isin("en", "de"), name).when(F.col("lang") == "fr", "").alias("call_id"),
        F.when(F.col("lang") == "fr", name).alias("id"),
        "text",
    )


_KEYED = "keyed AS (SELECT doc_id, CASE WHEN lang = 'es' THEN '' ELSE printf('doc-%05d', doc_id) END AS k, text FROM documents)"


def attach_gold(spark: SparkSession, folder: str) -> DataFrame:
    return labels.attach_gold(_keyed_docs(spark, folder), fr.gold(spark, folder)).select("doc_id", "text", "label")


def attach_gold_left(spark: SparkSession, folder: str) -> DataFrame:
    return labels.attach_gold(_keyed_docs(spark, folder), fr.gold(spark, folder), "left").select("doc_id", "label")


def match_stats(spark: SparkSession, folder: str) -> DataFrame:
    return labels.match_stats(_keyed_docs(spark, folder), fr.gold(spark, folder))


def to_sft_pair(spark: SparkSession, folder: str) -> DataFrame:
    return labels.to_sft_pair(labels.attach_gold(_keyed_docs(spark, folder), fr.gold(spark, folder)))


def map_columns(spark: SparkSession, folder: str) -> DataFrame:
    return labels.map_columns(fr.pairs(spark, folder).select("input", "output"))


def label_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return labels.label_distribution(fr.gold(spark, folder)).withColumn("fraud_share", F.round("fraud_share", 6))


def _split(spark: SparkSession, folder: str) -> DataFrame:
    return splits.seeded_split_exact(fr.pairs(spark, folder), ["id"])


def seeded_split_exact(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder)


def prepare_pairs_job(spark: SparkSession, folder: str) -> DataFrame:
    gold = fr.gold(spark, folder).withColumn("at", F.monotonically_increasing_id())
    return prepare_pairs(fr.calls(spark, folder), gold, ["at"])


def split_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_sizes(_split(spark, folder))


def seeded_split_hash(spark: SparkSession, folder: str) -> DataFrame:
    return splits.seeded_split_hash(fr.pairs(spark, folder), ["id"]).select("id", "split")


def leakage_check(spark: SparkSession, folder: str) -> DataFrame:
    return splits.leakage_check(_split(spark, folder))


def split_disjoint(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_disjoint(_split(spark, folder))


def seeded_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    return splits.seeded_shuffle(fr.pairs(spark, folder), ["id"])


def slice_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = fr.pairs(spark, folder).select("id", F.md5(F.concat(F.lit("42:"), "id")).alias("h"))
    ranked = ids.number_by_key(rows, ["h", "id"], "rank")
    return splits.slice_split(ranked, "rank", splits.split_sizes_for(rows.count())).select("id", "rank", "split")


def head_n(spark: SparkSession, folder: str) -> DataFrame:
    return ids.head_n(fr.pairs(spark, folder).select("id", "output"), ["id"])


def report_row_number(spark: SparkSession, folder: str) -> DataFrame:
    return ids.report_row_number(fr.answers(spark, folder).select("doc_id", "label"), ["doc_id"])


def _per_answer(name: str, build, column: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return fr.answers(spark, folder).select("doc_id", build(F.col(column)).alias(name))

    return query


def parse_with_confidence(spark: SparkSession, folder: str) -> DataFrame:
    found = an.parse_with_confidence(F.col("answer"))
    return fr.answers(spark, folder).select("doc_id", found.alias("found")).select("doc_id", "found.*")


def parse_judge(spark: SparkSession, folder: str) -> DataFrame:
    said = F.concat(F.lit("Score: "), F.when(F.col("label") == "fraud", "PASS").otherwise("FAIL"), F.lit("\n"), "answer")
    return fr.answers(spark, folder).select("doc_id", an.parse_judge(said).alias("judge_score"))


def _rounded(build, *columns: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        found = build(fr.scored(spark, folder))
        return found.withColumns({c: F.round(c, 6) for c in columns})

    return query


def macro_f1(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.macro_f1(fr.scored(spark, folder)).withColumn("macro_f1", F.round("macro_f1", 6))


def unparsed_count(spark: SparkSession, folder: str) -> DataFrame:
    rows = fr.answers(spark, folder).select(an.parse_fraud_first(F.col("answer")).alias("pred"))
    return metrics.unparsed_count(rows)


def judge_pass_rate(spark: SparkSession, folder: str) -> DataFrame:
    verdict = an.parse_judge(F.concat(F.lit("Score: "), F.when(F.col("gold") == F.col("pred"), "PASS").otherwise("FAIL")))
    rows = fr.scored(spark, folder).withColumn("judge_score", F.when(F.col("pred").isNotNull(), verdict))
    return metrics.judge_pass_rate(rows).withColumn("pass_rate", F.round("pass_rate", 6))


def exact_match(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.exact_match(fr.answers(spark, folder), "output", "label").withColumn("exact_match", F.round("exact_match", 6))


def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Both parsers as two runs of one job."""
    rows = fr.answers(spark, folder).select(
        F.col("label").alias("gold"),
        F.inline(F.array(
            F.struct(F.lit("contains").alias("mode"), an.parse_contains(F.col("answer")).alias("pred")),
            F.struct(F.lit("tag").alias("mode"), an.parse_result_tag(F.col("answer")).alias("pred")),
        )),
    )
    found = metrics.run_metrics(rows, by=["mode"])
    return found.withColumns({c: F.round(c, 6) for c in found.columns if c != "mode"})


def semantic_similarity(spark: SparkSession, folder: str) -> DataFrame:
    """Cosine of each vector with its successor."""
    vectors = fr.table(spark, folder, "embeddings").select("vec_id", "embedding")
    after = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    close = metrics.cosine(F.col("embedding"), F.col("next"))
    return vectors.join(after, "vec_id").select("vec_id", F.round(close, 6).alias("similarity"))


def answer_similarity(spark: SparkSession, folder: str) -> DataFrame:
    """Gold output and model answer of every row, compared as texts."""
    rows = similarity.text_similarity(fr.answers(spark, folder), "output", "answer")
    return rows.select("doc_id", F.round("similarity", 6).alias("similarity"))


def text_similarity(spark: SparkSession, folder: str) -> DataFrame:
    """Every text and its successor, whole."""
    docs = fr.table(spark, folder, "documents").select("doc_id", similarity.term_slots(F.col("text")).alias("text"))
    docs = settle(docs, "slots")  # each text is hashed once; the slots are joined
    after = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("next"))
    rows = similarity.text_similarity(docs.join(after, "doc_id"), "text", "next")
    return rows.select("doc_id", F.round("similarity", 6).alias("similarity"))


def mean_similarity(spark: SparkSession, folder: str) -> DataFrame:
    rows = answer_similarity(spark, folder)
    return similarity.mean_similarity(rows).withColumn("mean_similarity", F.round("mean_similarity", 6))


def similarity_sql(pairs: str) -> str:
    """Tables that end in `close` (doc_id, similarity) for `pairs` (doc_id, l, r)."""
    return f"""pairs AS ({pairs}),
  sides AS (SELECT doc_id, 'l' AS side, l AS words FROM pairs UNION ALL SELECT doc_id, 'r', r FROM pairs),
  words AS (SELECT doc_id, side, unnest(regexp_extract_all(lower(coalesce(words, '')), '[\\p{{L}}\\p{{N}}]+')) AS word FROM sides),
  counted AS (SELECT doc_id, side, ('0x' || substr(md5(word), 1, 8))::BIGINT % {similarity.SLOTS} AS slot, count(*) AS n FROM words GROUP BY ALL),
  rarity AS (SELECT slot, ln((1 + (SELECT count(*) FROM sides)) / (1 + count(*))) + 1 AS weight FROM counted GROUP BY slot),
  vectors AS (SELECT doc_id, side, slot, n * weight AS x FROM counted JOIN rarity USING (slot)),
  norms AS (SELECT doc_id, side, sqrt(sum(x * x)) AS norm FROM vectors GROUP BY ALL),
  products AS (SELECT a.doc_id, sum(a.x * b.x) AS dot FROM vectors a JOIN vectors b ON a.doc_id = b.doc_id AND a.slot = b.slot
    WHERE a.side = 'l' AND b.side = 'r' GROUP BY a.doc_id),
  close AS (SELECT p.doc_id, CASE WHEN a.norm * b.norm > 0 THEN round(least(1.0, coalesce(d.dot, 0) / (a.norm * b.norm)), 6) END AS similarity FROM pairs p
    LEFT JOIN products d ON d.doc_id = p.doc_id LEFT JOIN norms a ON a.doc_id = p.doc_id AND a.side = 'l'
    LEFT JOIN norms b ON b.doc_id = p.doc_id AND b.side = 'r')"""


def fraud_counter(spark: SparkSession, folder: str) -> DataFrame:
    rows = fr.answers(spark, folder).select(an.parse_contains(F.col("answer")).alias("label"))
    return metrics.fraud_counter(rows)


def zip_predictions(spark: SparkSession, folder: str) -> DataFrame:
    rows = fr.answers(spark, folder)
    texts = rows.select(F.col("doc_id").alias("row_id"), "input", "output")
    said = rows.select(F.col("doc_id").alias("row_id"), F.col("answer").alias("prediction"))
    return scoring.zip_predictions(texts, said)


def align_runs(spark: SparkSession, folder: str) -> DataFrame:
    rows = fr.answers(spark, folder).withColumnRenamed("doc_id", "row_id")
    base = rows.select("row_id", an.gold_normalized(F.col("output")).alias("gold"), an.parse_fraud_first(F.col("answer")).alias("pred"))
    tuned = rows.select("row_id", an.parse_binary(F.col("answer")).alias("pred"))
    return scoring.align_runs(base, tuned)


QUERIES = {
    "gold_last_wins": gold_last_wins,
    "attach_gold": attach_gold,
    "attach_gold_left": attach_gold_left,
    "match_stats": match_stats,
    "to_sft_pair": to_sft_pair,
    "map_columns": map_columns,
    "label_distribution": label_distribution,
    "seeded_split_exact": seeded_split_exact,
    "prepare_pairs": prepare_pairs_job,
    "split_sizes": split_sizes,
    "seeded_split_hash": seeded_split_hash,
    "leakage_check": leakage_check,
    "split_disjoint": split_disjoint,
    "seeded_shuffle": seeded_shuffle,
    "slice_split": slice_split,
    "head_n": head_n,
    "report_row_number": report_row_number,
    "gold_plain": _per_answer("gold", an.gold_plain, "output"),
    "gold_exact": _per_answer("gold", an.gold_exact, "output"),
    "gold_de": _per_answer("gold", an.gold_de, "output"),
    "gold_de_simple": _per_answer("gold", an.gold_de_simple, "output"),
    "gold_normalized": _per_answer("gold", an.gold_normalized, "output"),
    "parse_contains_raw": _per_answer("pred", an.parse_contains_raw, "answer"),
    "parse_contains": _per_answer("pred", an.parse_contains, "answer"),
    "parse_result_tag": _per_answer("pred", an.parse_result_tag, "answer"),
    "parse_fraud_first": _per_answer("pred", an.parse_fraud_first, "answer"),
    "parse_binary": _per_answer("pred", an.parse_binary, "answer"),
    "parse_with_confidence": parse_with_confidence,
    "parse_judge": parse_judge,
    "accuracy_percent": _rounded(metrics.accuracy_percent, "accuracy_percent"),
    "accuracy": _rounded(metrics.accuracy, "accuracy"),
    "match_rate": _rounded(metrics.match_rate, "match_rate_percentage"),
    "class_report": _rounded(metrics.class_report, "precision", "recall", "f1"),
    "weighted_prf": _rounded(metrics.weighted_prf, "weighted_precision", "weighted_recall", "weighted_f1"),
    "macro_f1": macro_f1,
    "binary_metrics": _rounded(metrics.binary_metrics, "accuracy", "precision", "recall", "f1"),
    "confusion_matrix": _rounded(metrics.confusion_matrix),
    "confusion_open": _rounded(metrics.confusion_open),
    "unparsed_count": unparsed_count,
    "judge_pass_rate": judge_pass_rate,
    "exact_match": exact_match,
    "run_metrics": run_metrics,
    "semantic_similarity": semantic_similarity,
    "answer_similarity": answer_similarity,
    "text_similarity": text_similarity,
    "mean_similarity": mean_similarity,
    "fraud_counter": fraud_counter,
    "zip_predictions": zip_predictions,
    "align_runs": align_runs,
}


# --- SQL ------------------------------------------------------------------------------------

_PAIRS, _ANSWERS, _SCORED = f"WITH {fr.PAIRS}", f"WITH {fr.ANSWERS}", f"WITH {fr.SCORED}"
_MATCHED = f"WITH {fr.GOLD}, {_KEYED}"


def _split_sql(source: str, key: str, columns: str) -> str:
    return (
        f"splitted AS (SELECT {columns}, CASE WHEN r < floor(n * 0.70::DOUBLE) THEN 'train' "
        "WHEN r < floor(n * 0.70::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'validation' ELSE 'test' END AS split, r "
        f"FROM (SELECT *, row_number() OVER (ORDER BY {fr.digest_sql(key)}) - 1 AS r, count(*) OVER () AS n FROM {source}))"
    )


_SPLIT = f"{_PAIRS}, {_split_sql('pairs', 'id', 'id, input, output')}"
_U = fr.uniform_sql(fr.digest_sql("id"))
_OUT = fr.strip_sql("output")
_FRAUD_FIRST = (
    f"CASE WHEN contains({{x}}, 'fraud') THEN 'fraud' WHEN contains({{x}}, 'legitimate') THEN 'legitimate' ELSE 'unparsed' END"
)
_FIRST_ANSWER = f"CASE WHEN answer IS NOT NULL THEN {_FRAUD_FIRST.format(x=fr.TIDY)} END"
_FIRST_OUTPUT = _FRAUD_FIRST.format(x=f"lower({_OUT})")
_BINARY = (
    "CASE WHEN answer IS NOT NULL THEN CASE WHEN contains(lower(string_split(answer, '### Response:' || chr(10))[-1]), 'fraud') "
    "THEN 'fraud' ELSE 'legitimate' END END"
)
_TAGGED = f"CASE WHEN answer IS NOT NULL THEN {fr.only_sql(fr.TIDY, 'result: legitimate', 'result: fraud', fr.lit('unknown'))} END"


def _answer_sql(name: str, expression: str) -> str:
    return f"{_ANSWERS} SELECT doc_id, {expression} AS {name} FROM answers"


def report_sql(source: str, by: str = "") -> str:
    """CTEs `counts` (one row per group) and `classes` (per label) over (gold, pred)."""
    group = f"{by}, " if by else ""
    return f"""counts AS (SELECT {group}count(*) AS total, count(pred) AS answered, count_if(gold = pred) AS correct,
    count_if(pred IS NOT NULL AND NOT (pred IN ('fraud', 'legitimate'))) AS outside FROM {source} GROUP BY {by or 'ALL'}),
  classes AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM (
    SELECT {group}name, support, CASE WHEN said > 0 THEN tp / said ELSE 0 END AS p,
      CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r, tp, said FROM (
      SELECT {group}name, count_if(gold = name AND pred = name) AS tp, count_if(pred = name) AS said,
        count_if(gold = name AND pred IS NOT NULL) AS support
      FROM {source}, (SELECT unnest(['fraud', 'legitimate']) AS name) GROUP BY ALL)))"""


def run_metrics_sql(by: str) -> str:
    """The five numbers per group from the CTEs of report_sql."""
    return f"""SELECT {by}, round(any_value(correct) / any_value(answered), 6) AS accuracy,
    round(sum(f * support) / sum(support), 6) AS weighted_f1, round(sum(p * support) / sum(support), 6) AS weighted_precision,
    round(sum(r * support) / sum(support), 6) AS weighted_recall,
    round(any_value(correct) / any_value(total) * 100, 6) AS match_rate_percentage
  FROM classes JOIN counts USING ({by}) GROUP BY {by}"""


_CLASSES = f"{_SCORED}, {report_sql('scored')}"

SQL = {
    "gold_last_wins": f"WITH {_REPEATED} SELECT id, label FROM last",
    "attach_gold": f"{_MATCHED} SELECT doc_id, text, label FROM keyed JOIN gold ON k = id",
    "attach_gold_left": f"{_MATCHED} SELECT doc_id, label FROM keyed LEFT JOIN gold ON k = id",
    "match_stats": f"{_MATCHED} SELECT count(*) AS total, count(label) AS matched, count(*) - count(label) AS unmatched "
    "FROM keyed LEFT JOIN gold ON k = id",
    "to_sft_pair": f"{_MATCHED} SELECT text AS input, label AS output FROM keyed JOIN gold ON k = id",
    "map_columns": f"{_PAIRS} SELECT input AS question, output AS answer FROM pairs",
    "label_distribution": f"WITH {fr.GOLD} SELECT count(*) AS total, count_if(label = 'legitimate') AS legitimate, "
    "count_if(label = 'fraud') AS fraud, round(count_if(label = 'fraud') / count(*), 6) AS fraud_share, "
    "count_if(label = 'fraud') > 0 AND count_if(label = 'legitimate') > 0 AND count_if(label = 'fraud') / count(*) "
    "BETWEEN 0.05 AND 0.95 AS passed FROM gold",
    "seeded_split_exact": f"{_SPLIT} SELECT id, input, output, split FROM splitted",
    "prepare_pairs": f"{_PAIRS}, {_split_sql('pairs', chr(40) + 'length(input) || chr(58) || input || length(output) || chr(58) || output' + chr(41), 'input, output')} "
    "SELECT input, output, split FROM splitted",
    "split_sizes": f"{_SPLIT} SELECT split, count(*) AS rows FROM splitted GROUP BY split",
    "seeded_split_hash": f"{_PAIRS} SELECT id, CASE WHEN {_U} < 0.7::DOUBLE THEN 'train' WHEN {_U} < 0.7::DOUBLE + 0.15::DOUBLE "
    "THEN 'validation' ELSE 'test' END AS split FROM pairs",
    "leakage_check": f"{_SPLIT} SELECT a AS split_a, b AS split_b, (SELECT count(*) FROM (SELECT input FROM splitted WHERE split = a "
    "INTERSECT SELECT input FROM splitted WHERE split = b)) AS shared_texts "
    "FROM (VALUES ('train', 'validation'), ('train', 'test'), ('validation', 'test')) AS t(a, b)",
    "split_disjoint": f"{_SPLIT} SELECT max(c) = 1 AS disjoint FROM (SELECT count(DISTINCT split) AS c FROM splitted GROUP BY input)",
    "seeded_shuffle": f"{_PAIRS} SELECT id, input, output FROM pairs ORDER BY {fr.digest_sql('id')}",
    "slice_split": f"{_SPLIT} SELECT id, r AS rank, split FROM splitted",
    "head_n": f"{_PAIRS} SELECT id, output FROM pairs ORDER BY id LIMIT 200",
    "report_row_number": f"{_ANSWERS} SELECT doc_id, label, row_number() OVER (ORDER BY doc_id) AS id FROM answers",
    "gold_plain": _answer_sql("gold", f"lower({_OUT})"),
    "gold_exact": _answer_sql("gold", _OUT),
    "gold_de": _answer_sql(
        "gold", f"CASE WHEN contains(lower({_OUT}), 'betrug') AND NOT contains(lower({_OUT}), 'kein') THEN 'fraud' ELSE 'legitimate' END"
    ),
    "gold_de_simple": _answer_sql("gold", "CASE WHEN contains(lower(output), 'betrug') THEN 'fraud' ELSE 'legitimate' END"),
    "gold_normalized": _answer_sql("gold", _FIRST_OUTPUT),
    "parse_contains_raw": _answer_sql(
        "pred", f"CASE WHEN answer IS NOT NULL THEN {fr.only_sql(fr.TIDY, 'legitimate', 'fraud', fr.TIDY)} END"
    ),
    "parse_contains": _answer_sql("pred", fr.PARSE_CONTAINS),
    "parse_result_tag": _answer_sql("pred", _TAGGED),
    "parse_fraud_first": _answer_sql("pred", _FIRST_ANSWER),
    "parse_binary": _answer_sql("pred", _BINARY),
    "parse_with_confidence": f"{_ANSWERS} SELECT doc_id, CASE WHEN contains(t, 'fraud') THEN 'fraud' WHEN contains(t, 'legit') "
    "THEN 'legit' ELSE 'unknown' END AS label, CASE WHEN contains(t, 'fraud') OR contains(t, 'legit') THEN 1.0::DOUBLE "
    "ELSE 0.0::DOUBLE END AS confidence FROM (SELECT doc_id, lower(coalesce(answer, '')) AS t FROM answers)",
    "parse_judge": f"{_ANSWERS} SELECT doc_id, CASE WHEN answer IS NOT NULL THEN CASE WHEN label = 'fraud' OR "
    "contains(lower(answer), 'score: pass') THEN 'PASS' ELSE 'FAIL' END END AS judge_score FROM answers",
    "accuracy_percent": f"{_SCORED} SELECT count_if(gold = pred) AS correct, count(pred) AS total, "
    "round(count_if(gold = pred) / count(pred) * 100, 6) AS accuracy_percent FROM scored",
    "accuracy": f"{_SCORED} SELECT round(count_if(gold = pred) / count(pred), 6) AS accuracy FROM scored",
    "match_rate": f"{_SCORED} SELECT round(count_if(gold = pred) / count(*) * 100, 6) AS match_rate_percentage FROM scored",
    "class_report": f"""{_CLASSES}
  SELECT name, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM classes
  UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(support)::BIGINT FROM classes
  UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
    round(sum(f * support) / sum(support), 6), sum(support)::BIGINT FROM classes
  UNION ALL SELECT CASE WHEN outside > 0 THEN 'micro avg' ELSE 'accuracy' END, round(mp, 6), round(mr, 6),
    round(2 * mp * mr / (mp + mr), 6), s FROM counts, (SELECT sum(tp) / sum(said) AS mp, sum(tp) / sum(support) AS mr,
    sum(support)::BIGINT AS s FROM classes)""",
    "weighted_prf": f"{_CLASSES} SELECT round(sum(p * support) / sum(support), 6) AS weighted_precision, "
    "round(sum(r * support) / sum(support), 6) AS weighted_recall, round(sum(f * support) / sum(support), 6) AS weighted_f1 FROM classes",
    "macro_f1": f"{_SCORED}, answered AS (SELECT * FROM scored WHERE pred IS NOT NULL) SELECT round(avg(2.0 * tp / (g + p)), 6) AS macro_f1 "
    "FROM (SELECT name, (SELECT count(*) FROM answered WHERE gold = name AND pred = name) AS tp, (SELECT count(*) FROM answered "
    "WHERE gold = name) AS g, (SELECT count(*) FROM answered WHERE pred = name) AS p FROM (SELECT gold AS name FROM answered "
    "UNION SELECT pred FROM answered))",
    "binary_metrics": f"""{_SCORED} SELECT tp, fp, fn, tn, round((tp + tn) / n, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision,
  round(tp / (tp + fn), 6) AS recall, round(2.0 * tp / (2 * tp + fp + fn), 6) AS f1 FROM (
  SELECT count(*) AS n, count_if(gold = 'fraud' AND pred = 'fraud') AS tp, count_if(gold = 'legitimate' AND pred = 'fraud') AS fp,
  count_if(gold = 'fraud' AND pred = 'legitimate') AS fn, count_if(gold = 'legitimate' AND pred = 'legitimate') AS tn FROM scored)""",
    "confusion_matrix": f"{_SCORED} SELECT g AS gold, (SELECT count(*) FROM scored WHERE gold = g AND pred = 'fraud') AS fraud, "
    "(SELECT count(*) FROM scored WHERE gold = g AND pred = 'legitimate') AS legitimate "
    "FROM (SELECT unnest(['fraud', 'legitimate']) AS g)",
    "confusion_open": f"{_SCORED} SELECT gold, pred, count(*) AS rows FROM scored WHERE pred IS NOT NULL GROUP BY gold, pred",
    "unparsed_count": f"{_ANSWERS} SELECT count_if({_FIRST_ANSWER} = 'unparsed') AS unparsed FROM answers",
    "judge_pass_rate": f"{_SCORED} SELECT count_if(gold = pred) AS passed, count(*) AS total, "
    "round(count_if(gold = pred) / count(*) * 100, 6) AS pass_rate FROM scored",
    "exact_match": f"{_ANSWERS} SELECT round(count_if(lower({_OUT}) = label) / count(*), 6) AS exact_match FROM answers",
    "run_metrics": f"""{_ANSWERS}, runs AS (SELECT 'contains' AS mode, label AS gold, {fr.PARSE_CONTAINS} AS pred FROM answers
  UNION ALL SELECT 'tag', label, {_TAGGED} FROM answers), {report_sql('runs', 'mode')}
  {run_metrics_sql('mode')}""",
    "semantic_similarity": "SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity "
    "FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
    "answer_similarity": f"{_ANSWERS}, {similarity_sql('SELECT doc_id, output AS l, answer AS r FROM answers')} SELECT * FROM close",
    "text_similarity": f"WITH {similarity_sql('SELECT a.doc_id, a.text AS l, b.text AS r FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1')} "
    "SELECT * FROM close",
    "mean_similarity": f"{_ANSWERS}, {similarity_sql('SELECT doc_id, output AS l, answer AS r FROM answers')} "
    "SELECT round(avg(similarity), 6) AS mean_similarity, count(similarity) AS compared, count(*) AS total FROM close",
    "fraud_counter": f"{_SCORED} SELECT count_if(pred = 'fraud') AS fraud_calls_total FROM scored",
    "zip_predictions": f"{_ANSWERS} SELECT doc_id AS row_id, input, output, answer AS prediction FROM answers",
    "align_runs": f"{_ANSWERS} SELECT doc_id AS row_id, {_FIRST_OUTPUT} AS gold, {_FIRST_ANSWER} AS base_pred, {_BINARY} AS tuned_pred FROM answers",
}
