"""JSON held in text columns, judged as a whole: trailing text after a JSON value makes it no JSON."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from callsift.functions.once import let

# Spark's parsers stop at 20 million characters and 1000 digits unless told otherwise.
OPTIONS = {"allowSingleQuotes": "false", "maxStringLen": "2147483647", "maxNumLen": "2147483647"}


def is_json(text: Column) -> Column:
    """Whether the text is exactly one JSON value of any size; false for null."""

    def whole(known: Column) -> Column:
        closed = F.from_json(F.concat(F.lit("["), known, F.lit(',"'), F.md5(known), F.lit('"]')), "array<string>", OPTIONS)
        return let(closed, lambda two: (F.size(two) == 2) & (F.try_element_at(two, F.lit(2)) == F.md5(known)))

    return F.coalesce(let(text, whole), F.lit(False))


def whole_json(text: Column, schema: str) -> Column:
    """The text parsed by a schema; null unless all of it is one JSON value."""
    return let(text, lambda known: F.when(is_json(known), F.from_json(known, schema, OPTIONS)))


def value_at(text: Column, path: str, kind: str) -> Column:
    """The value at a path such as `.a[0].b` of a text that is one JSON value; the last of repeated keys counts.

    Only the values on the path become a variant, so the rest may hold what a variant refuses: strings of any length,
    NaN, repeated keys. Null when the path is missing or the cast fails.
    """
    steps = [(name, int(place or 0)) for name, place in re.findall(r"\.(\w+)|\[(\d+)\]", path)]
    schema = "variant"
    for name, _ in reversed(steps):
        schema = f"struct<`{name}`:{schema}>" if name else f"array<{schema}>"
    value = F.from_json(text, schema, OPTIONS)
    for name, place in steps:
        value = value[name] if name else F.try_element_at(value, F.lit(place + 1))
    return value if kind == "variant" else F.try_variant_get(value, "$", kind)


def json_at(text: Column, path: str, kind: str) -> Column:
    """The value at a path, null when the text is no JSON, the path is missing or the cast fails."""
    return let(text, lambda known: F.when(is_json(known), value_at(known, path, kind)))


def has_key(text: Column, key: str) -> Column:
    """Whether a JSON object has the key, also with a null value; false for anything else."""
    return F.coalesce(F.map_contains_key(whole_json(text, "map<string,string>"), key), F.lit(False))
