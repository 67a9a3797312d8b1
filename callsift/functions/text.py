"""Text columns: strip, transcript flattening, encoding repair, length and noise marks."""

from __future__ import annotations

import json
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions.jsontext import whole_json
from callsift.functions.once import let

# Every code point that Python's str.strip() removes; Spark's trim() alone cuts plain spaces only.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

_TURNS = "transcript ARRAY<MAP<STRING, STRING>>"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """Null, empty or white space only."""
    return F.coalesce(strip(text), F.lit("")) == ""


def one_line(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(" "))


def padded_id(prefix: str, number: Column, digits: int) -> Column:
    """`prefix` + zero-padded number; longer numbers keep all their digits."""
    return F.format_string(f"{prefix}%0{digits}d", number.cast("bigint"))


def gold_label(*aliases: Column) -> Column:
    """First alias that is neither null nor empty."""
    return F.coalesce(*[F.nullif(alias, F.lit("")) for alias in aliases])


def document_key(call_id: Column, row_id: Column) -> Column:
    """Join key of a document: call id when it has one, else its id, else ''."""
    return F.coalesce(F.nullif(call_id, F.lit("")), row_id, F.lit(""))


def join_turns(turns: Column) -> Column:
    """`speaker: text` lines from ARRAY<MAP<STRING,STRING>>; a missing key gets its default, a JSON null reads None."""

    def said(turn: Column, key: str, default: str) -> Column:
        return F.when(F.map_contains_key(turn, key), F.coalesce(turn[key], F.lit("None"))).otherwise(F.lit(default))

    return F.array_join(
        F.transform(turns, lambda t: F.concat(said(t, "speaker", V.UNKNOWN_SPEAKER), F.lit(": "), said(t, "text", ""))),
        "\n",
    )


def flatten_transcript(text: Column, response: Column) -> Column:
    """The flat text when there is one (even ''), else the turns nested in the JSON `response`, else ''."""
    turns = whole_json(response, _TURNS)["transcript"]
    return F.coalesce(text, join_turns(turns), F.lit(""))


def broken_pairs() -> list[tuple[str, str]]:
    """(broken, clean) for the printable Latin-1 characters, as UTF-8 read in Latin-1 or in Windows-1252.

    The two lead characters themselves are left out, so that a second repair changes nothing.
    """
    pairs = []
    for code in range(0xA0, 0x100):
        clean = chr(code)
        if clean in "ÂÃ":
            continue
        raw = clean.encode("utf-8")
        for reading in ("latin-1", "cp1252"):
            broken = raw.decode(reading, errors="ignore")
            if len(broken) == 2 and (broken, clean) not in pairs:
                pairs.append((broken, clean))
    return pairs


def break_umlauts(text: Column) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), V.BROKEN_UMLAUTS, text)


def repair_unicode(text: Column, pairs: list[tuple[str, str]] | None = None) -> Column:
    """Undo doubly read UTF-8 in one pass: cut before each lead character, translate what a piece begins with.

    The longest broken form that fits is taken. Texts without a lead character are left alone.
    """
    pairs = broken_pairs() if pairs is None else pairs
    leads = sorted({broken[0] for broken, _ in pairs})
    sizes = sorted({len(broken) for broken, _ in pairs}, reverse=True)
    known = F.from_json(F.lit(json.dumps(dict(pairs))), "map<string,string>")

    def mend(piece: Column) -> Column:
        fits = [F.concat(F.try_element_at(known, F.left(piece, F.lit(n))), F.substring(piece, n + 1, 2**31 - 1)) for n in sizes]
        return F.coalesce(*fits, piece)

    cut = F.split(text, f"(?=[{re.escape(''.join(leads))}])")
    fixed = F.array_join(F.transform(cut, mend), "")
    return F.when(reduce(or_, [F.contains(text, F.lit(lead)) for lead in leads]), fixed).otherwise(text)


def _misread_forms() -> str:
    """Pattern of the two- to four-byte forms of UTF-8, with each byte read as a character of Latin-1."""
    tail = "[\\x{80}-\\x{BF}]"
    forms = [
        f"[\\x{{C2}}-\\x{{DF}}]{tail}", f"\\x{{E0}}[\\x{{A0}}-\\x{{BF}}]{tail}", f"[\\x{{E1}}-\\x{{EC}}\\x{{EE}}\\x{{EF}}]{tail}{{2}}",
        f"\\x{{ED}}[\\x{{80}}-\\x{{9F}}]{tail}", f"\\x{{F0}}[\\x{{90}}-\\x{{BF}}]{tail}{{2}}", f"[\\x{{F1}}-\\x{{F3}}]{tail}{{3}}", f"\\x{{F4}}[\\x{{80}}-\\x{{8F}}]{tail}{{2}}",
    ]
    return f"^(?:{'|'.join(forms)})"


def _as_latin(text: Column) -> Column:
    """Characters that Windows-1252 puts at bytes 80 to 9F, as the Latin-1 characters of those bytes."""
    given = {b: bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
    return F.translate(text, "".join(given.values()), "".join(chr(b) for b, c in given.items() if c))


def _mend_layer(text: Column) -> Column:
    """One reading undone: cut before each first byte of a form, and decode the form that a piece begins with."""

    def mend(piece: Column) -> Column:
        def decoded(latin: Column) -> Column:
            form = F.regexp_extract(latin, _misread_forms(), 0)
            clean = F.decode(F.encode(form, "ISO-8859-1"), "UTF-8")
            return F.when(form == "", piece).otherwise(F.concat(clean, F.substring(piece, F.length(form) + 1, F.lit(2**31 - 1))))

        return let(F.concat(_as_latin(F.left(piece, F.lit(4)))), decoded)

    return F.array_join(F.transform(F.split(text, "(?=[\\x{C2}-\\x{F4}])"), mend), "")


def repair_layers(text: Column) -> Column:
    """Undo UTF-8 that was read as Latin-1 or Windows-1252, however often: forms of two, three and four bytes.

    A reading turns every such character into at least two, so a text has no more layers than its length can be halved; each
    layer is one scan, and the scans end at the first text without a form. Null stays null. Only whole, valid forms are
    decoded; of characters that Windows-1252 lacks, those of Latin-1 are taken.
    """
    layers = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.log2(F.length(text) + 1)).cast("int")))

    def step(so_far: Column, _: Column) -> Column:
        again = F.struct(let(so_far["text"], _mend_layer).alias("text"), so_far["text"].alias("before"))
        return F.when(so_far["text"].eqNullSafe(so_far["before"]), so_far).otherwise(again)

    first = F.struct(text.alias("text"), F.lit(None).cast("string").alias("before"))
    whole = F.aggregate(layers, first, step, lambda done: done["text"])
    return F.when(text.rlike("[\\x{C2}-\\x{F4}]"), whole).otherwise(text)


def score_length(text: Column) -> Column:
    """Code points of the stripped text; 0 for null."""
    return F.coalesce(F.length(strip(text)), F.lit(0))


def long_enough(score: Column, least: int = V.MIN_LENGTH) -> Column:
    return score >= least


def garbage_test(text: Column) -> Column:
    return strip(text).isin(V.GARBAGE_TEXTS)


def _contains_any(text: Column, marks: list[str]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(mark)) for mark in marks])


def mojibake_test(text: Column) -> Column:
    return _contains_any(text, V.MOJIBAKE_MARKS)


def pii_keyword_test(text: Column) -> Column:
    return _contains_any(text, V.PII_KEYWORDS)


def dup_marker_test(call_id: Column) -> Column:
    return F.contains(call_id, F.lit(V.DUPLICATE_MARK))


def prohibited_test(text: Column) -> Column:
    return _contains_any(F.lower(text), V.PROHIBITED_PHRASES)
