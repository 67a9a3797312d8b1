"""The registered queries of this folder and, where SQL can express one, SQL that gives the same rows."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from callsift.llm import licenses
from callsift.llm.base import table
from callsift.llm.bin_completion import pack_best
from callsift.llm.neighbours import nearest_neighbours
from callsift.llm.packing import pack
from callsift.llm.part_codes import compress
from callsift.llm.quality_rules import apply_quality_rules
from callsift.llm.bpe import encode_decode
from callsift.llm.fill_in_middle import fill_in_middle, restore
from callsift.llm.language_id import predict, train
from callsift.llm.repeats import remove_repeats
from callsift.llm.simhash import simhash_components
from callsift.llm.tool_calls import link_tool_calls
from callsift.llm.warc import read_resolved, write_archive
from callsift.session import fresh_path, settle

QUERIES, SQL = {}, {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# --- 1: tool calls --------------------------------------------------------------------------------

TOOLS = {
    "ask": {
        "properties": {
            "text": {"type": "string", "minLength": 1, "maxLength": 400},
            "n_chars": {"type": "integer", "minimum": 1, "maximum": 300},
            "at": {"type": "object", "properties": {"turn": {"type": "integer"}, "role": {"type": "string", "enum": ["user"]}}, "required": ["turn"]},
        },
        "required": ["text", "n_chars"],
        "closed": True,
    },
    "note": {"properties": {"text": {"type": "string"}}, "required": ["text"], "closed": True},
}


@query
def op1_tool_calls(spark, folder):
    """Every turn of an assistant as the result of the turn before it, every other turn as a call.

    The conversations hold no calls of their own, so their turns are cast as calls: a user turn's call hangs on the call
    two turns before, its arguments carry the whole text. A turn of another role, or of none, is a call without a parent
    of a tool named by the role, which no schema knows.
    """
    turns = table(spark, folder, "conversations")
    name = lambda t: F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), t.cast("string"))
    text = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("t")))
    text = F.substr(text, F.lit(6), F.length(text) - 6)
    user, role = F.col("role").eqNullSafe(F.lit("user")), F.to_json(F.struct(F.coalesce("role", F.lit("")).alias("r")))
    calls = turns.where("NOT role <=> 'assistant'").select(
        F.col("conv_id").alias("group"),
        name(F.col("turn")).alias("call_id"),
        F.when(user & (F.col("turn") >= 2), name(F.col("turn") - 2)).alias("parent_id"),
        F.when(~user, F.concat(F.lit("role:"), F.coalesce("role", F.lit("")))).when(F.col("turn") % 7 == 3, "note").when(F.col("turn") % 7 == 5, "other").otherwise("ask").alias("name"),
        F.concat(
            F.lit('{ "text": '), text, F.lit(', "n_chars": '), F.length(F.coalesce("text", F.lit(""))).cast("string"),
            F.lit(', "at": {"turn": '), F.col("turn").cast("string"), F.lit(', "role": '), F.substr(role, F.lit(6), F.length(role) - 6), F.lit("} }"),
        ).alias("arguments"),
        "turn",
    )
    results = turns.where("role = 'assistant'").select(F.col("conv_id").alias("group"), name(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"), "turn")
    linked = link_tool_calls(calls, results, TOOLS)
    return linked.withColumn("errors", F.array_join("errors", ",")).withColumnRenamed("group", "conv_id")


SQL["op1_tool_calls"] = r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, 'call_' || conv_id || '_' || turn AS call_id, CASE WHEN role = 'user' AND turn >= 2 THEN 'call_' || conv_id || '_' || (turn - 2) END AS parent_id, coalesce(role, '') AS role,
         CASE WHEN role IS DISTINCT FROM 'user' THEN 'role:' || coalesce(role, '') WHEN turn % 7 = 3 THEN 'note' WHEN turn % 7 = 5 THEN 'other' ELSE 'ask' END AS name, coalesce(text, '') AS t FROM conversations WHERE role IS DISTINCT FROM 'assistant'),
r AS (SELECT conv_id, 'call_' || conv_id || '_' || (turn - 1) AS call_id, turn AS result_turn, text AS content FROM conversations WHERE role = 'assistant'),
d AS (SELECT c.conv_id, c.call_id, 0::BIGINT AS depth FROM c LEFT JOIN c p ON p.call_id = c.parent_id WHERE p.call_id IS NULL
      UNION ALL SELECT c.conv_id, c.call_id, d.depth + 1 FROM d JOIN c ON c.parent_id = d.call_id),
j AS (SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, c.parent_id, c.name, c.turn, c.t, c.role,
      r.content, r.result_turn, c.call_id IS NOT NULL AS has_call, r.call_id IS NOT NULL AS has_result FROM c FULL JOIN r ON c.call_id = r.call_id),
a AS (SELECT j.*, d.depth, p.call_id IS NULL AS lost,
      CASE WHEN has_call THEN '{"at":{"role":' || to_json(j.role) || ',"turn":' || j.turn || '},"n_chars":' || length(j.t) || ',"text":' || to_json(j.t) || '}' END AS arguments
      FROM j LEFT JOIN d ON d.call_id = j.call_id AND j.has_call LEFT JOIN c p ON p.call_id = j.parent_id)
SELECT conv_id, call_id, parent_id, name, turn, arguments,
  CASE WHEN NOT has_call THEN NULL WHEN name = 'other' OR starts_with(name, 'role:') THEN 'tool'
       WHEN name = 'note' THEN 'extra:at+n_chars'
       ELSE concat_ws(',', CASE WHEN length(t) < 1 OR length(t) > 400 THEN 'length:text' END, CASE WHEN length(t) < 1 OR length(t) > 300 THEN 'range:n_chars' END) END AS errors,
  content, result_turn, has_call::BIGINT AS n_calls, has_result::BIGINT AS n_results, depth,
  CASE WHEN NOT has_call THEN 'orphan' WHEN parent_id IS NOT NULL AND lost THEN 'unknown_parent' WHEN NOT has_result THEN 'no_result' ELSE 'linked' END AS status,
  CASE WHEN has_call THEN '{"arguments":' || arguments || ',"id":"' || call_id || '","name":"' || name || '"' || CASE WHEN content IS NULL THEN '' ELSE ',"result":' || to_json(content) END || '}' END AS json,
  row_number() OVER (PARTITION BY conv_id ORDER BY depth NULLS LAST, turn NULLS LAST, result_turn NULLS LAST, call_id) AS place
FROM a
"""

# --- 2: repeated substrings -----------------------------------------------------------------------


@query
def op2_suffix_dedup(spark, folder):
    """What is left of every document without strings of 100 bytes that start earlier."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# --- 3: nearest neighbours ------------------------------------------------------------------------


@query
def op3_nearest(spark, folder):
    """The five nearest of every vector whose id is divisible by 50."""
    vectors = table(spark, folder, "embeddings")
    return nearest_neighbours(vectors, vectors.where("vec_id % 50 = 0"))


# --- 4: WARC --------------------------------------------------------------------------------------


@query
def op4_warc_revisits(spark, folder):
    """All pages written as archives and read back."""
    path = fresh_path(spark, "warc")
    write_archive(table(spark, folder, "pages"), path)
    return read_resolved(spark, path).select(
        F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long")
    )


SQL["op4_warc_revisits"] = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT page_id, unnest(range(8)) AS g FROM p),
b AS (SELECT page_id, g, ('0x' || substr(h, 1 + 5 * g, 5))::BIGINT AS v FROM g JOIN p USING (page_id)),
c AS (SELECT page_id, string_agg(list_aggregate(list_transform([15, 10, 5, 0],
      lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> s) & 31)::INT, 1)), 'string_agg', ''), '' ORDER BY g) AS payload_digest FROM b GROUP BY page_id),
f AS (SELECT page_id, payload_bytes, payload_digest, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p JOIN c USING (page_id))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to FROM f
"""

# --- 5: BPE ---------------------------------------------------------------------------------------


@query
def op5_bpe(spark, folder):
    """Ids of every document and the text that they decode to, as digests."""
    return encode_decode(table(spark, folder, "documents")).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


# --- 6: language ID -------------------------------------------------------------------------------


@query
def op6_language_id(spark, folder):
    """Predicted language of every document, learned from the documents that are not held out."""
    docs = table(spark, folder, "documents").withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2)
    model = train(docs.where("NOT held_out"))
    return predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


# --- 7: SimHash -----------------------------------------------------------------------------------


@query
def op7_simhash(spark, folder):
    """Fingerprint and component of every document."""
    return simhash_components(table(spark, folder, "documents"))


# --- 8: quality rules -----------------------------------------------------------------------------


@query
def op8_quality_rules(spark, folder):
    """Counts and verdict of every document."""
    return apply_quality_rules(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_boilerplate_words", "kept"
    )


SQL["op8_quality_rules"] = r"""
WITH d AS (SELECT doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
wi AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
tri AS (SELECT doc_id, i, word || ' ' || lead(word) OVER v || ' ' || lead(word, 2) OVER v AS t FROM wi WINDOW v AS (PARTITION BY doc_id ORDER BY i)),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) > 1 AS hit FROM tri WHERE t IS NOT NULL),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) WHERE hit GROUP BY doc_id),
sp AS (SELECT doc_id, host, string_split(text, chr(10)) AS parts FROM d),
li AS (SELECT doc_id, host, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM sp),
lw AS (SELECT *,
       regexp_replace(trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[\x20\x09-\x0D]+', ' ', 'g'), ' '), '[0-9]+', '0', 'g') AS norm,
       len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM li),
dup AS (SELECT doc_id, sum(n - 1)::BIGINT AS n FROM (SELECT doc_id, line, count(*) AS n FROM lw WHERE words > 0 GROUP BY ALL) GROUP BY doc_id),
whole AS (SELECT doc_id, string_agg(norm, chr(10) ORDER BY i) AS whole FROM lw WHERE norm <> '' GROUP BY doc_id),
bad AS (SELECT host, norm FROM lw JOIN whole USING (doc_id) WHERE norm <> '' GROUP BY host, norm HAVING count(DISTINCT whole) > 20),
cut AS (SELECT doc_id, sum(words)::BIGINT AS n FROM lw JOIN bad USING (host, norm) GROUP BY doc_id),
c AS (SELECT d.doc_id, len(w.ws)::BIGINT AS n_words, length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
      length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
      coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(cut.n, 0)::BIGINT AS n_boilerplate_words
      FROM d JOIN w USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN cut USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT *, NOT base_failed AND 100 * n_boilerplate_words <= 50 * n_words AS kept FROM f
"""

# --- 9: licences ----------------------------------------------------------------------------------


@query
def op9_licenses(spark, folder):
    """Confirmed licence families of every document, how many predictions were not confirmed, and how many notices are of no known family."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = licenses.scan(docs, licenses.train(docs)).drop("text")
    sure = F.filter("licenses", lambda x: x["match"] >= licenses.CONFIRM)
    other = F.size(F.filter("licenses", lambda x: x["family"] == licenses.UNKNOWN))
    return found.select(
        "doc_id",
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))), ",").alias("families"),
        F.size(sure).cast("long").alias("n_confirmed"),
        (F.size("licenses") - F.size(sure) - other).cast("long").alias("n_unconfirmed"),
        other.cast("long").alias("n_unknown"),
        F.array_max(F.transform(sure, lambda x: x["probability"])).alias("probability"),
    )


# --- 10: packing ----------------------------------------------------------------------------------


@query
def op10_packing(spark, folder):
    """Pieces of all documents in sequences of 2048 tokens."""
    return pack(table(spark, folder, "documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


# --- 11: vector codes -----------------------------------------------------------------------------


@query
def op11_vector_codes(spark, folder):
    """Code and error of every vector, the errors of its label, and a digest of the codebooks."""
    rows, model = compress(table(spark, folder, "embeddings").select("vec_id", "label", "embedding"))
    coded = settle(rows.select("vec_id", "label", F.lower(F.hex("codes")).alias("code"), "error"), "codes")
    labels = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "l")
    books = F.lit(hashlib.sha256(model.text().encode()).hexdigest())
    joined = coded.join(labels, F.col("label").eqNullSafe(F.col("l")))
    return joined.select("vec_id", "code", "error", "label_error", books.alias("codebooks_sha256"))


def codebook_rounds(rounds):
    """SQL of the rounds: `aN` assigns by the books `bN`, which then become the next ones."""
    for i in range(rounds + 1):
        yield f"""
dist{i} AS (SELECT a.v, a.p, b.e, sum((a.x - b.x) * (a.x - b.x)) AS d FROM parts a JOIN b{i} b ON a.p = b.p AND a.j = b.j GROUP BY a.v, a.p, b.e),
a{i} AS MATERIALIZED (SELECT v, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM dist{i} GROUP BY v, p)"""
        if i < rounds:
            yield f"""
m{i} AS (SELECT a.p, a.e, x.j, floor(sum(x.x) / count(*))::BIGINT AS x FROM a{i} a JOIN parts x ON x.v = a.v AND x.p = a.p GROUP BY a.p, a.e, x.j),
b{i + 1} AS MATERIALIZED (SELECT b.p, b.e, b.j, coalesce(m{i}.x, b.x) AS x FROM b{i} b LEFT JOIN m{i} USING (p, e, j))"""


SQL["op11_vector_codes"] = (
    r"""
WITH kept AS (SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
flat AS (SELECT v, len(embedding) // 4 AS w, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM kept),
parts AS MATERIALIZED (SELECT v, i // w AS p, i % w AS j, floor(1024 * x::DOUBLE)::BIGINT AS x FROM flat),
b0 AS MATERIALIZED (SELECT p, (v - 1)::INT AS e, j, x FROM parts WHERE v <= 256),"""
    + ",".join(codebook_rounds(4))
    + r""",
books AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM b4),
codes AS (SELECT v, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a4 GROUP BY v)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN codes USING (v), books
"""
)

# --- 12: fill in the middle -----------------------------------------------------------------------


@query
def op12_fill_in_middle(spark, folder):
    """Digests of every document with its middle moved to the end, and of the text rebuilt from that."""
    made = restore(fill_in_middle(table(spark, folder, "documents").select("doc_id", "text")).drop("text"))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


SQL["op12_fill_in_middle"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS units, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
      ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
f AS (SELECT *, len(units)::BIGINT AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
      CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(list_slice(units, 1, a), ''), '') AS prefix, coalesce(array_to_string(list_slice(units, a + 1, b), ''), '') AS middle,
      coalesce(array_to_string(list_slice(units, b + 1, n), ''), '') AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p
"""

# --- 13: best-fit packing -------------------------------------------------------------------------


@query
def op13_best_fit(spark, folder):
    """Pieces of all documents in as few sequences of 4096 tokens as the search finds."""
    return pack_best(table(spark, folder, "documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
