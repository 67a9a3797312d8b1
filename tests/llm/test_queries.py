"""Registered queries against their SQL, and the operators on odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from callsift.llm import language_id as L
from callsift.llm import quality_rules as Q
from callsift.llm import simhash as S
from callsift.llm import tool_calls as C
from callsift.llm import warc as W
from callsift.llm.queries import QUERIES, SQL
from callsift.session import fresh_path
from tests.compare import connect, difference
from tests.llm.test_pipeline import components

FOLDER = "/root/testdata/sf0.01"
LONG = "(" * 3 + "x" * 200_000 + " " + "y\n" * 50_000


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(spark, name):
    assert difference(spark, connect(FOLDER), QUERIES[name], SQL[name], FOLDER) is None


def test_registered_names():
    assert sorted(int(x[2:].split("_")[0]) for x in QUERIES) == list(range(1, 14))


# --- 8 --------------------------------------------------------------------------------------------


def test_rules_on_odd_rows(spark):
    rows = [(None, None, None, 1), (1, "", "a", 2), (1, "", "a", 2), (2, LONG, "a", 3), (3, "\x85   ", "a", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int")
    got = {r["doc_id"]: r for r in Q.apply_quality_rules(df).collect()}
    assert got[None]["n_words"] == 0 and got[None]["base_failed"] and got[None]["clean_text"] is None
    assert got[2]["n_words"] == 50_001 and got[2]["n_dup_lines"] == 49_998 and got[2]["base_failed"]
    assert got[3]["n_words"] == 2 and got[3]["word_chars"] == 3
    assert Q.apply_quality_rules(df).count() == 5 and Q.apply_quality_rules(df.limit(0)).count() == 0


def test_copies_do_not_make_their_lines_boilerplate(spark):
    draw = random.Random(1)
    sentence = lambda n: " ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(n))
    copied = "\n".join(sentence(20) for _ in range(4))
    rows = [(i, copied, "h") for i in range(300)]
    rows += [(1000 + i, sentence(60) + "\nRead 12 more here\n" + sentence(5), "h") for i in range(200)]
    rows += [(2000 + i, "Read 7 more  here\n" * 60 + sentence(3), "h") for i in range(30)]
    got = {r["doc_id"]: r for r in Q.apply_quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i]["kept"] and got[i]["clean_text"] == copied for i in range(300))
    assert all(got[1000 + i]["kept"] and got[1000 + i]["n_boilerplate_words"] == 4 for i in range(200))
    assert not any(got[2000 + i]["kept"] for i in range(30))


@pytest.mark.parametrize("broadcast", [Q.MOST_BROADCAST, 0])
def test_shared_lines_are_counted_by_documents(spark, broadcast):
    """Two shared lines longer than any other; a plain count over sets of texts, without the operator's helpers."""
    draw = random.Random(4)
    sentence = lambda n: " ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(n))
    shared = [sentence(40), sentence(30)]
    rows = [(i, "\n".join([*shared, *(sentence(12) for _ in range(6))]), "h") for i in range(300)]
    rows += [(1000 + i, "\n".join([shared[0], *(sentence(12) for _ in range(6))]), "few") for i in range(20)]
    rows += [(2000 + i, shared[1], "one") for i in range(40)]
    holders = {}
    for _, text, host in rows:
        for line in text.split("\n"):
            holders.setdefault((host, line), set()).add(text)
    bad = {k for k, v in holders.items() if len(v) > 20}
    assert bad == {("h", shared[0]), ("h", shared[1])}
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in Q.apply_quality_rules(df, broadcast=broadcast).collect()}
    for name, text, host in rows:
        left = [x for x in text.split("\n") if (host, x) not in bad]
        gone = len(text.split()) - len(" ".join(left).split())
        assert (got[name]["clean_text"], got[name]["n_boilerplate_words"]) == ("\n".join(left), gone)


def test_a_line_goes_by_documents_whatever_the_size_of_its_host(spark):
    """The same lines in 21 documents of a small and of a large host; columns named like internal ones pass."""
    draw = random.Random(6)
    sentence = lambda n: " ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(n))
    rows = [(i, f"the common notice of 7 words here\n{sentence(60)}" if i % 100 < 21 and i < 200 else sentence(60), "small" if i < 100 else "large") for i in range(900)]
    df = spark.createDataFrame([(*r, 1, "x", 3, 4) for r in rows], "doc_id long, text string, source string, _host int, _lines string, line int, c0 int")
    got = Q.apply_quality_rules(df.repartition(7)).collect()
    assert {r["doc_id"] for r in got if r["n_boilerplate_words"] == 7} == {i for i in range(200) if i % 100 < 21}
    assert all(r["kept"] and "notice" not in r["clean_text"] and (r["_host"], r["_lines"], r["line"], r["c0"]) == (1, "x", 3, 4) for r in got)


# --- 7 --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("bucket", [S.BUCKET, 3])
def test_components_by_all_levels(spark, bucket):
    """Fingerprints around a few centres: chains and clusters, also where every bucket must be divided."""
    draw, prints = random.Random(2), []
    for _ in range(12):
        at = draw.getrandbits(64)
        for _ in range(15):
            prints.append(at)
            for bit in draw.sample(range(64), draw.randint(0, 4)):
                at ^= 1 << bit
    prints = sorted(set(prints))
    points = spark.createDataFrame([(S.signed(p), i) for i, p in enumerate(prints)], "fp long, node long")
    from callsift.llm.components import connected_components

    found = {r["node"]: r["component"] for r in connected_components(S.bucket_links(points, 3, bucket)).collect()}
    assert [found.get(i, i) for i in range(len(prints))] == components(prints)


def test_masks_cover():
    draw = random.Random(3)
    for level in range(3):
        masks = S.covering_masks(3, level)
        for _ in range(500):
            x = sum(1 << b for b in draw.sample(range(64), 3))
            assert any(not x & m for m in masks)


def test_simhash_query_and_odd_rows(spark):
    rows = [(5, None), (4, ""), (9, "A b"), (7, "a B"), (7, "a B"), (None, "a b"), (1, LONG), (2, "Été x"), (3, "été x")]
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in S.simhash_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(got) == len(rows)
    by = {d: (f, c) for d, f, c in got}
    assert by[5] == by[4] == ("0" * 16, 4) and by[9] == by[7] == by[None] and by[7][1] == 7
    assert by[2][0] != by[3][0] and by[2][0] == format(S.fingerprint("Été X"), "016x")
    assert S.simhash_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    folder = "/root/testdata/sf0.001"
    found = sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in QUERIES["op7_simhash"](spark, folder).collect())
    part = components([int(f, 16) for _, f, _ in found])
    assert [c for _, _, c in found] == [found[i][0] for i in part]


def test_fingerprint_by_definition():
    import xxhash

    text = "The quick Brown fox\tjumps\nover the quick brown fox"
    words = text.lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(len(words) - 2)]
    wanted = sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))
    assert S.fingerprint(text) == wanted


# --- 6 --------------------------------------------------------------------------------------------


def test_copies_do_not_rule_the_language_sample(spark):
    rows = [("der hund und die katze", "de")] * 300 + [(f"das haus und der garten {x}", "de") for x in "abc"] + [("the dog and the cat", "en")] * 300
    df = spark.createDataFrame(rows, "text string, lang string")
    model, plain = L.train(df), L.train(df.distinct())
    assert model.languages == plain.languages == ["de", "en"] and np.array_equal(model.weights, plain.weights)
    assert L.train(df, sample=0).languages == ["de", "en"]


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op6_language_id"](spark, FOLDER).join(docs, "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 150 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_many_languages_and_odd_rows(spark):
    draw = random.Random(5)
    alphabets = {f"l{i}": "".join(draw.sample("abcdefghijklmnopqrstuvwxyz", 8)) for i in range(9)}
    text = lambda a: " ".join("".join(draw.choices(a, k=5)) for _ in range(60))
    rows = [(i, text(alphabets[k]), k) for i, k in enumerate(list(alphabets) * 12)] + [(900, None, "l1"), (901, text("abc"), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(df)
    assert model.codes.shape[0] == 9 and len({tuple(r) for r in model.codes.tolist()}) == 9
    odd = spark.createDataFrame([(1, None, 0.5), (2, "12 ?!", 0.5), (3, LONG, 0.5), (4, text(alphabets["l3"]), 0.5)], "doc_id long, text string, score double")
    got = {r["doc_id"]: r for r in L.predict(odd, model).collect()}
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == "und" and got[1]["score"] == 0.0
    assert got[4]["lang_pred"] == "l3" and got[3]["lang_pred"] in alphabets
    assert L.predict(odd, L.train(df.limit(0))).where("lang_pred = 'und'").count() == 4
    one = L.train(df.where("lang = 'l3'"))
    assert {r["lang_pred"] for r in L.predict(odd, one).collect()} == {"und", "l3"}
    assert L.predict(odd.limit(0), model).count() == 0


# --- 4 --------------------------------------------------------------------------------------------


def test_archives_of_odd_pages(spark):
    tricky = ["", None, "a\r\n\r\nb", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response", "WARC/1.1\r\n", "end\r\n\r\n", "\r\n\r\n", "é\U0001f600", LONG, "a\r\n\r\nb"]
    rows = [(i, f"http://h/{i} \r\nX: y", t) for i, t in enumerate(tricky)] + [(None, None, "q"), (3, "u", tricky[3])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    path = fresh_path(spark, "warc")
    W.write_archive(df, path)
    assert len(W.read_archive(spark, path).collect()) == len(rows)
    payloads = {r["key"]: bytes(r["payload"]) for r in W.read_archive(spark, path).where("record_type = 'response'").collect()}
    got = {r["key"]: r for r in W.read_resolved(spark, path).collect()}
    for i, t in enumerate(tricky):
        r = got[str(i)]
        assert r["payload_bytes"] == len((t or "").encode())
        if r["record_type"] == "response":
            assert payloads[str(i)] == (t or "").encode()
    assert got["1"]["refers_to"] == "0" and got["9"]["refers_to"] == "2" and got["3"]["record_type"] == "response"
    path = fresh_path(spark, "warc")
    W.write_archive(df, path, least=10)
    assert {r["key"] for r in W.read_resolved(spark, path).where("record_type = 'revisit'").collect()} == set()
    path = fresh_path(spark, "warc")
    W.write_archive(df.limit(0), path)
    assert W.read_resolved(spark, path).count() == 0


def test_repeated_keys_keep_their_own_payload(spark):
    """Also columns named like internal ones, and every payload back from the archive."""
    rows = [(1, "aaaa", "u1"), (1, "bbbbbb", "u2"), (2, "aaaa", "u3"), (3, "bbbbbb", "u4"), (1, "aaaa", "u0"), (None, "aaaa", "u5")]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], "page_id long, html string, url string, first int, payload_digest int, found int, n int")
    path = fresh_path(spark, "warc")
    W.write_archive(df, path, date="2030-01-02T03:04:05Z")
    got = sorted(((r["key"] or "", r["payload_bytes"], r["record_type"], r["refers_to"]) for r in W.read_resolved(spark, path).collect()), key=repr)
    assert got == [("", 4, "response", None), ("1", 4, "response", None), ("1", 4, "response", None), ("1", 6, "response", None), ("2", 4, "revisit", "1"), ("3", 6, "revisit", "1")]
    whole = sorted(((r["key"] or "", bytes(r["payload"]).decode()) for r in W.read_payloads(spark, path).collect()))
    assert whole == sorted((str(k or ""), t) for k, t, _ in rows)
    heads = {r["key"]: r for r in W.read_archive(spark, path).where("record_type = 'revisit'").collect()}
    assert heads["2"]["refers_to_url"] == "u0" and heads["3"]["refers_to_url"] == "u2" and heads["2"]["date"] == "2030-01-02T03:04:05Z"
    found = W.resolve_revisits(df, "page_id", "html", url="url").collect()
    assert all((r["first"], r["found"], r["n"]) == (1, 3, 4) and len(r["payload_digest"]) == 32 for r in found)
    text = "".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect())
    assert text.count("WARC-Type: warcinfo") == 1 and text.count("WARC-Refers-To-Date: 2030") == 2


# --- 1 --------------------------------------------------------------------------------------------

SCHEMAS = {
    "f": {
        "properties": {
            "n": {"type": "integer", "minimum": 1, "maximum": 5},
            "s": {"type": "string", "enum": ["a", "b"]},
            "o": {"type": "object", "properties": {"x": {"type": "number"}}, "required": ["x"], "closed": True},
        },
        "required": ["n"],
        "closed": True,
    }
}


def test_linking_on_odd_rows(spark):
    calls = [
        (1, "a", None, "f", '{"n": 2, "s":"b"}', 1), (1, "a", None, "f", '{"n": 2, "s":"b"}', 1), (1, "b", "a", "f", '{"s":"c"}', 0),
        (1, "c", "b", "f", '{"n":9, "o":{"y":1}}', 2), (1, "x", "y", "f", "{}", 3), (1, "y", "x", "g", "{}", 4), (1, "z", "y", "f", "[1]", 5),
        (1, "l", "gone", "f", '{"n":1} x', 6), (2, "a", None, "f", None, 1), (None, "a", None, "f", '{"n":1}', 1), (3, None, None, "f", '{"n":1.5}', 1),
    ]
    results = [(1, "a", "r2", 3), (1, "a", "r1", 2), (1, "b", None, 0), (1, "c", "early", 1), (1, "nobody", "r", 9), (None, "a", "rn", 2)]
    df = spark.createDataFrame([(*c, "extra") for c in calls], "group long, call_id string, parent_id string, name string, arguments string, turn long, place string")
    res = spark.createDataFrame(results, "group long, call_id string, content string, turn long")
    got = {(r["group"], r["call_id"]): r for r in C.link_tool_calls(df, res, SCHEMAS).collect()}
    assert len(got) == 11
    status = {k: r["status"] for k, r in got.items()}
    assert status[1, "a"] == "linked" and got[1, "a"]["content"] == "r1" and (got[1, "a"]["n_calls"], got[1, "a"]["n_results"]) == (2, 2)
    assert status[1, "b"] == "linked" and status[1, "c"] == "early_result" and status[1, "nobody"] == "orphan"
    assert status[1, "x"] == status[1, "y"] == status[1, "z"] == "cycle" and status[1, "l"] == "unknown_parent"
    assert status[2, "a"] == "no_result" and status[None, "a"] == "linked" and status[3, None] == "no_result"
    assert [got[1, x]["depth"] for x in "abcx"] == [0, 1, 2, None]
    assert got[1, "a"]["place"] < got[1, "b"]["place"] < got[1, "c"]["place"]
    assert sorted(r["place"] for k, r in got.items() if k[0] == 1) == list(range(1, 9))
    errors = {k: list(r["errors"]) if r["errors"] is not None else None for k, r in got.items()}
    assert errors[1, "a"] == [] and errors[1, "b"] == ["missing:n", "enum:s"] and errors[1, "c"] == ["range:n", "missing:o.x", "extra:o.y"]
    assert errors[1, "y"] == ["tool"] and errors[1, "z"] == ["object"] and errors[1, "l"] == ["json"] and errors[2, "a"] == ["json"]
    assert errors[3, None] == ["type:n"] and errors[1, "nobody"] is None
    assert got[1, "a"]["json"] == '{"arguments":{"n":2,"s":"b"},"id":"a","name":"f","result":"r1"}'
    assert C.link_tool_calls(df.limit(0), res.limit(0), SCHEMAS).count() == 0


def test_long_chain_in_any_order(spark):
    order = list(range(300))
    random.Random(6).shuffle(order)
    calls = [(1, f"c{i}", f"c{i - 1}" if i else None, "f", "{}", order[i]) for i in range(300)]
    df = spark.createDataFrame(calls, "group long, call_id string, parent_id string, name string, arguments string, turn long")
    res = spark.createDataFrame([], "group long, call_id string, content string, turn long")
    got = C.link_tool_calls(df, res, SCHEMAS).collect()
    assert all(r["place"] == int(r["call_id"][1:]) + 1 == r["depth"] + 1 for r in got)


def test_tool_calls_run_no_python(spark):
    plan = QUERIES["op1_tool_calls"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_numbers_of_any_spelling_and_long_arguments(spark):
    schema = {"t": {"properties": {"i": {"type": "integer"}, "n": {"type": "number", "maximum": 10}, "s": {"type": "string"}}, "closed": True}}
    cases = {'{"i":3.0}': "", '{"i":12345678901234567890}': "", '{"i":1e2}': "", '{"i":1.5}': "type:i", '{"i":"3"}': "type:i", '{"n":1e400}': "type:n", '{"n":1e1}': "", '{"n":10.5}': "range:n", '{"i":1}x': "json"}
    long = '{"s":"' + "x" * 21_000_000 + '"}'
    rows = [(1, f"c{i}", None, "t", a, i) for i, a in enumerate([*cases, long])]
    calls = spark.createDataFrame(rows, "group long, call_id string, parent_id string, name string, arguments string, turn long")
    results = spark.createDataFrame([], "group long, call_id string, content string, turn long")
    got = {r["call_id"]: r for r in C.link_tool_calls(calls, results, schema).selectExpr("call_id", "array_join(errors, ',') AS errors", "length(arguments) AS size").collect()}
    assert [got[f"c{i}"]["errors"] for i in range(len(cases))] == list(cases.values())
    assert got[f"c{len(cases)}"]["errors"] == "" and got[f"c{len(cases)}"]["size"] == len(long)
