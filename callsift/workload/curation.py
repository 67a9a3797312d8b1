"""Queries over text operators, noise, duplicates and ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions import draws, masking, text as tx
from callsift.functions.once import choose, let, literal_array, pin
from callsift.operators import dedup, gates, ids, noise, scoring
from callsift.plans.curate import curate
from callsift.workload import frames as fr

docs = fr.documents


def curate_documents(spark: SparkSession, folder: str) -> DataFrame:
    return curate(docs(spark, folder).select("doc_id", "text"), "doc_id")


def curate_noisy(spark: SparkSession, folder: str) -> DataFrame:
    return curate(fr.noisy(spark, folder), "call_id")


def mask_pii(spark: SparkSession, folder: str) -> DataFrame:
    return docs(spark, folder).select("doc_id", masking.mask_pii(F.col("text")).alias("text"))


def mask_pii_samples(spark: SparkSession, folder: str) -> DataFrame:
    sample = choose(V.PII_SAMPLES, draws.pick(draws.digest(42, F.col("doc_id")), 0, len(V.PII_SAMPLES)))
    longer = F.concat("text", F.lit("\n"), sample)
    return docs(spark, folder).select("doc_id", let(longer, masking.mask_pii).alias("text"))


def is_pii_present(spark: SparkSession, folder: str) -> DataFrame:
    return docs(spark, folder).select("doc_id", masking.is_pii_present(F.col("text")).alias("pii"))


_TALK = [*V.PROHIBITED_PHRASES, "Guten Tag", "Wie geht es", "SAG MIR DEIN PASSWORT", "Danke"]


def compliance_check(spark: SparkSession, folder: str) -> DataFrame:
    said = choose(_TALK, draws.pick(draws.digest(42, F.col("doc_id")), 0, len(_TALK)))
    longer = F.concat("text", F.lit(" "), said)
    return docs(spark, folder).select("doc_id", let(longer, masking.compliance_check).alias("decision"))


def score_length(spark: SparkSession, folder: str) -> DataFrame:
    return docs(spark, folder).select("doc_id", tx.score_length(F.concat(F.lit("\t\u00a0"), "text", F.lit(" \n"))).alias("score"))


def min_length_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = docs(spark, folder).select("doc_id", "text")
    kept = scoring.apply_filter(rows, "text", tx.score_length, tx.long_enough, score_column="score")
    return kept.select("doc_id", "score")


def modifier_chain(spark: SparkSession, folder: str) -> DataFrame:
    rows = docs(spark, folder).select("doc_id", tx.break_umlauts(F.col("text")).alias("text"))
    return scoring.apply_modifiers(rows, "text", tx.repair_unicode, masking.mask_pii, tx.strip)


def break_umlauts(spark: SparkSession, folder: str) -> DataFrame:
    return docs(spark, folder).select("doc_id", tx.break_umlauts(F.col("text")).alias("text"))


_LATIN = [(clean, broken) for broken, clean in tx.broken_pairs() if broken == clean.encode().decode("latin-1")]


def repair_unicode(spark: SparkSession, folder: str) -> DataFrame:
    letters = literal_array([{"clean": clean, "wrong": wrong} for clean, wrong in _LATIN], "struct<clean: string, wrong: string>")
    broken = F.aggregate(letters, F.col("text"), lambda t, pair: F.replace(t, pair["clean"], pair["wrong"]))
    rows = pin(docs(spark, folder).select("doc_id", "text"), "broken", broken)
    return rows.select("doc_id", F.length("broken").alias("broken_length"), tx.repair_unicode(F.col("broken")).alias("text"))


def _other_id() -> Column:
    """Id of a row that stands beside a real one."""
    return (-F.col("doc_id") - 1).alias("doc_id")


def flatten_transcript(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a document as nested turns, as flat text or without speakers, by language; beside each, broken JSON."""
    lines = F.split("text", "\n")
    turns = F.transform(lines, lambda x: F.struct(F.col("source").alias("speaker"), x.alias("text")))
    lone = F.transform(lines, lambda x: F.struct(x.alias("text")))
    nested = (
        F.when(F.col("lang") == "en", F.to_json(F.struct(turns.alias("transcript"))))
        .when(F.col("lang") == "fr", F.to_json(F.struct(lone.alias("transcript"))))
        .when(F.col("lang") == "de", F.to_json(F.struct(turns.alias("transcript"))))
    )
    flat = F.when(F.col("lang") == "es", F.col("text"))
    whole = docs(spark, folder).select("doc_id", flat.alias("flat"), nested.alias("nested"))
    half = whole.select(_other_id(), F.lit(None).cast("string").alias("flat"), F.concat("nested", F.lit(" and more")).alias("nested"))
    rows = whole.unionByName(half)
    return rows.select("doc_id", tx.flatten_transcript(F.col("flat"), F.col("nested")).alias("text"))


def flatten_turns(spark: SparkSession, folder: str) -> DataFrame:
    turn = F.struct(F.col("role").alias("speaker"), "text")
    nested = F.to_json(F.struct(F.array(turn).alias("transcript")))
    rows = fr.table(spark, folder, "conversations")
    return rows.select("conv_id", "turn", tx.flatten_transcript(F.lit(None).cast("string"), nested).alias("text"))


def _gappy(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """All documents; beside Spanish ones an empty text, beside German ones white space, beside French ones null."""
    rows = docs(spark, folder)
    gap = F.when(F.col("lang") == "es", "").when(F.col("lang") == "de", "  \n")
    gaps = rows.where("lang <> 'en'").select(_other_id(), gap.alias(name))
    return rows.select("doc_id", F.col("text").alias(name)).unionByName(gaps)


_GAPPY = (
    "(SELECT doc_id, text AS x FROM documents UNION ALL SELECT -doc_id - 1, CASE lang WHEN 'es' THEN '' WHEN 'de' THEN '  ' || chr(10) END "
    "FROM documents WHERE lang <> 'en')"
)


def drop_empty_text(spark: SparkSession, folder: str) -> DataFrame:
    return noise.drop_empty_text(_gappy(spark, folder, "text"))


def drop_empty_input(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.drop_empty_input(_gappy(spark, folder, "input"))


def reject_blank_input(spark: SparkSession, folder: str) -> DataFrame:
    good, blank = scoring.reject_blank_input(_gappy(spark, folder, "text"))
    return good.withColumn("error", F.lit(None).cast("string")).unionByName(blank)


def inject_noise(spark: SparkSession, folder: str) -> DataFrame:
    return fr.noisy(spark, folder)


def noise_stats(spark: SparkSession, folder: str) -> DataFrame:
    return noise.noise_stats(fr.calls(spark, folder))


def noise_presence_gate(spark: SparkSession, folder: str) -> DataFrame:
    return noise.noise_presence(fr.noisy(spark, folder))


def emit_duplicate(spark: SparkSession, folder: str) -> DataFrame:
    return fr.calls(spark, folder).select(F.inline(noise.emit_duplicate(F.col("call_id"), F.col("text"))))


def _mark(name: str, test, column: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return fr.noisy(spark, folder).select("call_id", test(F.col(column)).alias(name))

    return query


def schema_gate(spark: SparkSession, folder: str) -> DataFrame:
    named = F.struct("doc_id", F.when(F.col("lang") == "fr", F.lit(None)).otherwise(F.col("text")).alias("text"))
    other = F.struct("doc_id", F.col("text").alias("body"))
    line = F.when(F.col("lang") == "de", F.to_json(other)).otherwise(F.to_json(named, {"ignoreNullFields": "false"}))
    return gates.schema_gate(docs(spark, folder).select(line.alias("value")))


def row_relation_gate(spark: SparkSession, folder: str) -> DataFrame:
    return gates.row_relation_gate(fr.noisy(spark, folder), fr.gold(spark, folder))


def short_ratio_gate(spark: SparkSession, folder: str) -> DataFrame:
    return gates.short_ratio_gate(fr.noisy(spark, folder))


def duplicate_groups(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.duplicate_groups(docs(spark, folder).select("doc_id", "text"), "doc_id")


def keep_first_duplicate(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.keep_first_duplicate(docs(spark, folder).select("doc_id", "text"), "doc_id")


def drop_duplicates_by_id(spark: SparkSession, folder: str) -> DataFrame:
    rows = docs(spark, folder).select("doc_id", "text")
    return dedup.drop_duplicates_by_id(rows, dedup.later_duplicates(rows, "doc_id"), "doc_id")


def curation_stats(spark: SparkSession, folder: str) -> DataFrame:
    masked = docs(spark, folder).select(masking.mask_pii(tx.repair_unicode(F.col("text"))).alias("text"))
    stats = dedup.curation_stats(masked)
    return stats.withColumn("removed_percent", F.round("removed_percent", 6))


def add_id(spark: SparkSession, folder: str) -> DataFrame:
    return ids.add_id(fr.table(spark, folder, "documents").select("doc_id"), ["doc_id"])


def add_id_by_position(spark: SparkSession, folder: str) -> DataFrame:
    return ids.add_id(fr.table(spark, folder, "documents").select("doc_id"))


def position_fallback_id(spark: SparkSession, folder: str) -> DataFrame:
    rows = docs(spark, folder).select(
        "doc_id",
        F.when(F.col("lang") == "de", F.concat(F.lit("call-"), "doc_id")).alias("call_id"),
        F.when(F.col("lang") != "en", F.concat(F.lit("row-"), "doc_id")).alias("id"),
    )
    return ids.position_fallback_id(rows, order_by=["doc_id"]).select("doc_id", "call_id")


QUERIES = {
    "curate_documents": curate_documents,
    "curate_noisy": curate_noisy,
    "mask_pii": mask_pii,
    "mask_pii_samples": mask_pii_samples,
    "is_pii_present": is_pii_present,
    "compliance_check": compliance_check,
    "score_length": score_length,
    "min_length_filter": min_length_filter,
    "modifier_chain": modifier_chain,
    "break_umlauts": break_umlauts,
    "repair_unicode": repair_unicode,
    "flatten_transcript": flatten_transcript,
    "flatten_turns": flatten_turns,
    "drop_empty_text": drop_empty_text,
    "drop_empty_input": drop_empty_input,
    "reject_blank_input": reject_blank_input,
    "inject_noise": inject_noise,
    "noise_stats": noise_stats,
    "noise_presence_gate": noise_presence_gate,
    "emit_duplicate": emit_duplicate,
    "garbage_test": _mark("garbage", tx.garbage_test, "text"),
    "mojibake_test": _mark("mojibake", tx.mojibake_test, "text"),
    "pii_keyword_test": _mark("pii_keyword", tx.pii_keyword_test, "text"),
    "dup_marker_test": _mark("dup_marker", tx.dup_marker_test, "call_id"),
    "schema_gate": schema_gate,
    "row_relation_gate": row_relation_gate,
    "short_ratio_gate": short_ratio_gate,
    "duplicate_groups": duplicate_groups,
    "keep_first_duplicate": keep_first_duplicate,
    "drop_duplicates_by_id": drop_duplicates_by_id,
    "curation_stats": curation_stats,
    "add_id": add_id,
    "add_id_by_position": add_id_by_position,
    "position_fallback_id": position_fallback_id,
}

_CLEAN = fr.mask_sql(fr.replace_sql("text", tx.broken_pairs()))


def _curate_sql(rows: str, row_id: str, columns: str) -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY {row_id}) AS n FROM "
        f"(SELECT * REPLACE ({_CLEAN} AS text) FROM {rows}) WHERE length({fr.strip_sql('text')}) >= 50) WHERE n = 1"
    )


def _or_contains(x: str, marks: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {fr.lit(m)})" for m in marks) + ")"


_NOISY = "WITH " + fr.noisy_sql()
_H = fr.digest_sql("doc_id")
_TALKED = f"(text || ' ' || {fr.choose_sql(_TALK, fr.pick_sql(_H, 0, len(_TALK)))})"
_GARBAGE = f"{fr.strip_sql('text')} IN ({', '.join(map(fr.lit, V.GARBAGE_TEXTS))})"
_HASHED = "(SELECT doc_id, text, md5(text) AS _hashes, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS n, count(*) OVER (PARTITION BY md5(text)) AS c FROM documents)"

SQL = {
    "curate_documents": _curate_sql("(SELECT doc_id, text FROM documents)", "doc_id", "doc_id, text"),
    "curate_noisy": f"{_NOISY} {_curate_sql('noisy', 'call_id', 'call_id, text, is_clean, noise_type')}",
    "mask_pii": f"SELECT doc_id, {fr.mask_sql('text')} AS text FROM documents",
    "mask_pii_samples": "SELECT doc_id, "
    + fr.mask_sql(f"(text || chr(10) || {fr.choose_sql(V.PII_SAMPLES, fr.pick_sql(_H, 0, len(V.PII_SAMPLES)))})")
    + " AS text FROM documents",
    "is_pii_present": f"SELECT doc_id, {fr.mask_sql('text')} <> text AS pii FROM documents",
    "compliance_check": f"SELECT doc_id, CASE WHEN {fr.mask_sql('t')} <> t OR {_or_contains('lower(t)', V.PROHIBITED_PHRASES)} "
    f"THEN 'refuse' ELSE 'approve' END AS decision FROM (SELECT doc_id, {_TALKED} AS t FROM documents)",
    "score_length": "SELECT doc_id, length("
    + fr.strip_sql("(chr(9) || chr(160) || text || ' ' || chr(10))")
    + ")::INTEGER AS score FROM documents",
    "min_length_filter": f"SELECT doc_id, length({fr.strip_sql('text')})::INTEGER AS score FROM documents "
    f"WHERE length({fr.strip_sql('text')}) >= 50",
    "modifier_chain": "SELECT doc_id, "
    + fr.strip_sql(fr.mask_sql(fr.replace_sql(fr.replace_sql("text", V.BROKEN_UMLAUTS), tx.broken_pairs())))
    + " AS text FROM documents",
    "break_umlauts": f"SELECT doc_id, {fr.replace_sql('text', V.BROKEN_UMLAUTS)} AS text FROM documents",
    "repair_unicode": f"SELECT doc_id, length(b)::INTEGER AS broken_length, {fr.replace_sql('b', tx.broken_pairs())} AS text "
    f"FROM (SELECT doc_id, {fr.replace_sql('text', _LATIN)} AS b FROM documents)",
    "flatten_transcript": "SELECT -doc_id - 1 AS doc_id, '' AS text FROM documents UNION ALL SELECT doc_id, CASE lang "
    "WHEN 'en' THEN array_to_string([source || ': ' || x FOR x IN string_split(text, chr(10))], chr(10)) "
    "WHEN 'fr' THEN array_to_string(['Unbekannt: ' || x FOR x IN string_split(text, chr(10))], chr(10)) "
    "WHEN 'es' THEN text ELSE array_to_string([source || ': ' || x FOR x IN string_split(text, chr(10))], chr(10)) END FROM documents",
    "flatten_turns": "SELECT conv_id, turn, role || ': ' || text AS text FROM conversations",
    "drop_empty_text": f"SELECT doc_id, x AS text FROM {_GAPPY} WHERE length(x) > 0",
    "drop_empty_input": f"SELECT doc_id, x AS input FROM {_GAPPY} WHERE coalesce(x, '') <> ''",
    "reject_blank_input": f"SELECT doc_id, x AS text, CASE WHEN coalesce({fr.strip_sql('x')}, '') = '' "
    f"THEN {fr.lit(V.BLANK_INPUT_ERROR)} END AS error FROM {_GAPPY}",
    "inject_noise": f"{_NOISY} SELECT * FROM noisy",
    "noise_stats": f"{_NOISY} SELECT branch, count(*) AS calls FROM branched GROUP BY branch",
    "noise_presence_gate": f"{_NOISY} SELECT bool_or(contains(call_id, '_DUP')) AS has_duplicates, "
    f"bool_or({_or_contains('text', V.PII_KEYWORDS)}) AS has_pii, bool_or({_GARBAGE}) AS has_garbage, "
    f"bool_or({_or_contains('text', V.MOJIBAKE_MARKS)}) AS has_encoding_errors FROM noisy",
    "emit_duplicate": f"WITH {fr.CALLS} SELECT call_id, text, true AS is_clean, 'none' AS noise_type FROM calls UNION ALL "
    "SELECT call_id || '_DUP', text, false, 'exact_duplicate' FROM calls",
    "garbage_test": f"{_NOISY} SELECT call_id, {_GARBAGE} AS garbage FROM noisy",
    "mojibake_test": f"{_NOISY} SELECT call_id, {_or_contains('text', V.MOJIBAKE_MARKS)} AS mojibake FROM noisy",
    "pii_keyword_test": f"{_NOISY} SELECT call_id, {_or_contains('text', V.PII_KEYWORDS)} AS pii_keyword FROM noisy",
    "dup_marker_test": f"{_NOISY} SELECT call_id, contains(call_id, '_DUP') AS dup_marker FROM noisy",
    "schema_gate": "SELECT count(*) AS total, count_if(lang = 'de') AS missing, count(*) > 0 AND count_if(lang = 'de') = 0 "
    "AS passed FROM documents",
    "row_relation_gate": f"{_NOISY}, {fr.GOLD} SELECT n AS noisy_rows, g AS gold_rows, g > 0 AND n >= g AS passed "
    "FROM (SELECT count(*) AS n FROM noisy), (SELECT count(*) AS g FROM gold)",
    "short_ratio_gate": f"{_NOISY} SELECT count(*) AS total, count_if(length({fr.strip_sql('text')}) < 20) AS short, "
    f"count_if(length({fr.strip_sql('text')}) < 20) <= count(*) * 0.05::DOUBLE AS passed FROM noisy",
    "duplicate_groups": f"SELECT doc_id, _hashes FROM {_HASHED} WHERE c > 1",
    "keep_first_duplicate": f"SELECT doc_id, text FROM {_HASHED} WHERE n = 1",
    "drop_duplicates_by_id": f"SELECT doc_id, text FROM {_HASHED} WHERE n = 1",
    "curation_stats": "SELECT a AS rows_in, s AS too_short, a - s - k AS duplicates, k AS kept, a - k AS removed, "
    "round((a - k) * 100.0::DOUBLE / a, 6) AS removed_percent FROM (SELECT count(*) AS a, "
    f"count_if(length({fr.strip_sql('t')}) < 50) AS s, count(DISTINCT CASE WHEN length({fr.strip_sql('t')}) >= 50 THEN md5(t) END) AS k "
    f"FROM (SELECT {_CLEAN} AS t FROM documents))",
    "add_id": "SELECT doc_id, printf('FRAUD_data-%010d', row_number() OVER (ORDER BY doc_id) - 1) AS id FROM documents",
    "add_id_by_position": "SELECT doc_id, printf('FRAUD_data-%010d', row_number() OVER (ORDER BY doc_id) - 1) AS id FROM documents",
    "position_fallback_id": "SELECT doc_id, coalesce(CASE WHEN lang = 'de' THEN 'call-' || doc_id END, "
    "CASE WHEN lang <> 'en' THEN 'row-' || doc_id END, printf('CALL_%04d', row_number() OVER (ORDER BY doc_id) - 1)) AS call_id "
    "FROM documents",
}
