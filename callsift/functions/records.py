"""JSON records by spans: one pass over a line finds where each value is, so that values are cut out and never rewritten."""

from __future__ import annotations

import json
import re
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from callsift.functions.jsontext import OPTIONS
from callsift.functions.once import let

SPANS = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("size", T.IntegerType())]))
KINDS = {'"': "string", "{": "object", "[": "array", "t": "boolean", "f": "boolean", "n": "null"}

_blank = re.compile(r"[ \t\n\r]*").match
# numbers and constants stay text, whatever their length
_value = json.JSONDecoder(strict=False, parse_int=str, parse_float=str, parse_constant=str).scan_once


def spans_of(line: str | None) -> list[tuple[str, str, int, int]] | None:
    """(key, kind, start, characters) of the values of a JSON object, in the order of their keys; null for anything else.

    Of a repeated key the last value counts, at the place of the first.
    """
    if line is None:
        return None
    found: dict[str, tuple[str, int, int]] = {}
    try:
        at = _blank(line, 0).end()
        if line[at] != "{":
            return None
        at = _blank(line, at + 1).end()
        while line[at] != "}":
            if line[at] != '"':
                return None
            key, at = scanstring(line, at + 1, False)
            at = _blank(line, at).end()
            if line[at] != ":":
                return None
            start = _blank(line, at + 1).end()
            at = scanstring(line, start + 1, False)[1] if line[start] == '"' else _value(line, start)[1]
            found[key] = (KINDS.get(line[start], "number"), start, at - start)
            at = _blank(line, at).end()
            if line[at] == ",":
                at = _blank(line, at + 1).end()
                if line[at] == "}":
                    return None
            elif line[at] != "}":
                return None
    except (IndexError, ValueError, StopIteration, RecursionError):
        return None
    if _blank(line, at + 1).end() != len(line):
        return None
    return [(key.encode("utf-8", "replace").decode(), *span) for key, span in found.items()]


@F.arrow_udf(SPANS)
def record_spans(lines: pa.Array) -> pa.Array:
    """The spans of each line (see spans_of); positions are in characters, as Spark counts them."""
    found = (spans_of(line.as_py()) for line in lines)
    rows = [None if spans is None else [dict(zip(("key", "kind", "start", "size"), s)) for s in spans] for spans in found]
    return pa.array(rows, to_arrow_type(SPANS))


def _cut(line: Column, span: Column) -> Column:
    return F.substr(line, span["start"] + 1, span["size"])


def record_text(line: Column, spans: Column, key: str) -> Column:
    """The value of a key as text: a string's content, any other value as it is written; null for null or no value."""

    def text(span: Column) -> Column:
        raw = _cut(line, span)
        content = F.from_json(F.concat(F.lit("["), raw, F.lit("]")), "array<string>", OPTIONS)
        return F.when(span["kind"] == "string", F.try_element_at(content, F.lit(1))).when(span["kind"] != "null", raw)

    return let(F.try_element_at(F.filter(spans, lambda s: s["key"] == key), F.lit(1)), text)


def text_json(text: Column) -> Column:
    """A text as JSON string; null as null."""
    whole = F.to_json(F.struct(text.alias("t")), {"ignoreNullFields": "false"})
    return F.substring(F.left(whole, F.length(whole) - 1), 6, 2**31 - 1)


def record_line(line: Column, spans: Column, replaced: dict[str, Column]) -> Column:
    """The record as one JSON line, with some values replaced by texts; all others are cut from the line as they are."""
    kept = F.filter(spans, lambda s: ~s["key"].isin(list(replaced)))
    others = F.transform(kept, lambda s: F.concat(text_json(s["key"]), F.lit(":"), _cut(line, s)))
    new = F.array(*[F.concat(F.lit(f"{json.dumps(name)}:"), text_json(value)) for name, value in replaced.items()])
    return F.concat(F.lit("{"), F.array_join(F.concat(new, others), ","), F.lit("}"))
