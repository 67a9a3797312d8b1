"""Quality rules: repetition and symbol counts of each text, and lines that recur across the documents of a host."""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsift.llm.base import BLANKS, map_columns, slices, utf8
from callsift.session import settle

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: A line is boilerplate if more documents of its host hold it.
LINE_DOCUMENTS = 20
#: Boilerplate lines that are broadcast at most (about 100 bytes each); with more, texts are joined with their own.
MOST_BROADCAST = 1 << 18
#: A document is depleted if its boilerplate lines hold more than this share of its words.
MOST_REMOVED_PERCENT = 50


def normal_line(line: str) -> str:
    """Lower case (A to Z), runs of digits as 0, runs of blanks as one space, none outside."""
    words = utf8(line).lower().split()
    return re.sub(r"[0-9]+", "0", b" ".join(words).decode("utf-8", "replace"))


def repeated_words(words: list) -> int:
    """Words inside three-word windows that occur at least twice, counted once each."""
    n = len(words) - 2
    if n < 2:
        return 0
    seen: dict = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    pairs = ids[:-1] * len(seen) + ids[1:]
    if len(seen) > 2_000_000:  # keeps the next product within 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    triples = pairs[:-1] * len(seen) + ids[2:]
    order = np.argsort(triples, kind="stable")
    same = triples[order][1:] == triples[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n + 2, bool)
    for shift in range(3):
        covered[shift : shift + n] |= again
    return int(covered.sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    text = text or ""
    data = utf8(text)
    words = data.split()
    seen, dup = set(), 0
    for line in data.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip():
            seen.add(line)
    blanks = sum(text.count(c) for c in BLANKS)
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return len(words), len(text) - blanks, symbols, dup, repeated_words(words)


def document_lines(text: str | None) -> list[tuple[int, int]]:
    """Hash of each distinct normalised line, each with the hash of the whole normalised text.

    The whole text tells documents apart: copies of one document count as one, so that many copies of a clean document do
    not turn its lines into boilerplate. Documents that differ in any line count each.
    """
    lines = [x for x in map(normal_line, (text or "").split("\n")) if x]
    whole = xxhash.xxh64_intdigest(utf8("\n".join(lines))) >> 1
    return [(xxhash.xxh64_intdigest(utf8(x)) >> 1, whole) for x in set(lines)]


def lines_of(rows: DataFrame) -> DataFrame:
    """host, name, line, whole: the distinct lines of each text. `rows`: host, name, text."""

    def make():
        def work(columns):
            for some in slices(columns):
                out = {x: [] for x in ("host", "name", "line", "whole")}
                for host, name, text in zip(*(some[x].to_pylist() for x in ("host", "name", "text"))):
                    found = document_lines(text)
                    out["host"] += [host] * len(found)
                    out["name"] += [name] * len(found)
                    out["line"] += [x for x, _ in found]
                    out["whole"] += [y for _, y in found]
                yield out

        return work

    return map_columns(rows, make, "host string, name long, line long, whole long")


def boilerplate_lines(rows: DataFrame, least: int) -> DataFrame:
    """host, line: the hashes of lines that over `least` texts of a host hold. Counted with partial sums."""
    often = lines_of(rows).select("host", "line", "whole").distinct().groupBy("host", "line").count()
    return settle(often.where(F.col("count") > least).select("host", "line"), "boilerplate")


def apply_quality_rules(
    df: DataFrame,
    text: str = "text",
    host: str = "source",
    least: int = LINE_DOCUMENTS,
    removed_percent: int = MOST_REMOVED_PERCENT,
    broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """Every row with its counts, the text without boilerplate lines, and the verdict.

    Adds (or replaces) n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_boilerplate_words,
    clean_text and kept. A line goes if over `least` documents of its host hold it, as told apart by their whole
    normalised texts; a document goes if such lines hold over `removed_percent` of its words. Null text: no words, hence
    base_failed. Null hosts form one host of their own. Repeated rows are judged alike; other columns, of any name, pass
    through; an empty table gives an empty table.

    The text is read twice: once for the lines, once to judge it. Up to `broadcast` boilerplate lines, counted, go to every
    task, and no text is shuffled. Beyond that, each text meets the list of its own such lines, by host and a hash of the
    text; texts that share a hash share both lists, which changes nothing: a line goes only where it stands.
    """
    made = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    made += "n_boilerplate_words long, clean_text string, kept boolean"
    names = [x.split()[0] for x in made.split(", ")]
    rest = [(f"c{i}", f) for i, f in enumerate(df.schema.fields) if f.name not in names]
    body = F.col(f"`{text}`")
    rows = df.select(
        *[F.col(f"`{f.name}`").alias(c) for c, f in rest],
        F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("\0")).alias("host"), F.xxhash64(body).alias("name"), body.alias("text"),
    )
    named = rows.select("host", "name", "text")
    bad = boilerplate_lines(named, least)
    lists: dict[str, set[int]] = {}
    if bad.count() <= broadcast:
        for r in bad.collect():
            lists.setdefault(r["host"], set()).add(r["line"])
        rows = rows.withColumn("lines", F.lit(None).cast("array<long>"))
    else:
        own = lines_of(named).join(bad, ["host", "line"], "left_semi").groupBy("host", "name").agg(F.collect_set("line").alias("lines"))
        rows = rows.join(settle(own, "of-texts"), ["host", "name"], "left")
    shared = df.sparkSession.sparkContext.broadcast(lists)

    def make():
        def judge(value, lines):
            counts = base_counts(value)
            failed = counts[0] < LEAST_WORDS or 100 * counts[4] > MOST_REPEATED_PERCENT * counts[0]
            clean, removed = value, 0
            if lines and value:
                left = []
                for line in value.split("\n"):
                    short = normal_line(line)
                    if short and xxhash.xxh64_intdigest(utf8(short)) >> 1 in lines:
                        removed += len(utf8(line).split())
                    else:
                        left.append(line)
                clean = "\n".join(left) if removed else value
            return *counts, failed, removed, clean, not failed and 100 * removed <= removed_percent * counts[0]

        def work(columns):
            known = shared.value
            for some in slices(columns):
                gone = [known.get(h) or set(own or ()) for h, own in zip(some["host"].to_pylist(), some["lines"].to_pylist())]
                found = map(judge, some[whole].to_pylist(), gone)
                yield {c: some[c] for c, _ in rest} | dict(zip(names, map(list, zip(*found))))

        return work

    schema = T.StructType([T.StructField(c, f.dataType, f.nullable) for c, f in rest] + T._parse_datatype_string(made).fields)
    whole = next((c for c, f in rest if f.name == text), "text")  # a text that passes through is sent once
    out = map_columns(rows.select(*dict.fromkeys([*[c for c, _ in rest], "host", whole, "lines"])), make, schema)
    return out.select(*[F.col(c).alias(f.name) for c, f in rest], *names)
