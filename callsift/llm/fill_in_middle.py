"""Fill-in-the-middle rows: one match of a repeated group gives every unit of a text and so both cuts."""

from __future__ import annotations

import hashlib

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsift.llm.base import map_columns, portions

#: A unit is a run of letters or any other single character. Possessive: a text is matched in one pass, without going back.
UNITS = r"([A-Za-z]++|[^A-Za-z])*+"
OTHER = regex.compile("[^A-Za-z]")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Documents in a hundred that are transformed, and transformed ones in a hundred with the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
SEED = 1
#: Characters that are taken at once.
CHUNK = 1_000_000

MADE = "n long, form string, prefix_chars long, middle_chars long, output string"


def draws(seed: int, key: object) -> list[int]:
    """Four unsigned 32-bit numbers from seed and key; a null key draws as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def unit_ends(text: str, units: regex.Pattern) -> np.ndarray:
    """Where the units of a text end: one match that keeps all repetitions of its group.

    The library's memory for repetitions is limited, so a text of over CHUNK characters is matched in portions of about that
    size, each up to behind a character that is no letter, where a unit ends in any case.
    """
    found, at = [], 0
    while len(text) - at > CHUNK:
        border = OTHER.search(text, at + CHUNK)
        if not border:
            break
        found.append(np.array(units.fullmatch(text, at, border.end()).ends(1)))
        at = border.end()
    found.append(np.array(units.fullmatch(text, at).ends(1), np.int64))
    return np.concatenate(found)


def transform(text: str, chosen: list[int], units: regex.Pattern) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, prefix and middle characters, output) of one text by its four draws."""
    ends = unit_ends(text, units)
    n = len(ends)
    one, two, plain, order = chosen
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or plain % 100 >= TRANSFORMED:
        return n, "plain", None, None, text
    first, second = sorted((one % (n + 1), two % (n + 1)))
    a, b = (int(ends[cut - 1]) if cut else 0 for cut in (first, second))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if order % 100 < SUFFIX_FIRST:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restored_text(output: str, form: str) -> str:
    """The text that an output was made of. Its parts hold no marker, so the first marker of each kind is the border."""
    if form == "plain":
        return output
    opening, between = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    first, _, rest = output.removeprefix(opening).partition(between)
    second, _, middle = rest.partition(MIDDLE)
    return first + middle + second if form == "psm" else second + middle + first


def fill_in_middle(df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """Every row with n, form, prefix_chars, middle_chars, output: its text with the middle moved to the end.

    n is the number of units of the text. Two of the n + 1 borders, drawn by seed and key, cut it in prefix, middle and
    suffix. Form `psm` is `<P>`prefix`<S>`suffix`<M>`middle, `spm` is `<S>`suffix`<P>`prefix`<M>`middle, `plain` is the
    text as it is: an empty or null one (n 0, output empty), one that holds a marker, and a tenth of all others. Characters
    are code points, null where plain. Rows with equal key and text get equal results; an empty table gives none. Other
    columns pass through; those named like results are replaced.

    Narrow: no shuffle. Texts of a batch are taken in portions, so a task holds the units of one portion, or of one longer text.
    """
    made = T._parse_datatype_string(MADE).fields
    rest = [f for f in df.schema.fields if f.name not in {m.name for m in made}]
    rows = df.select(*[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(rest)], F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{text}`").alias("text"))

    def make():
        units = regex.compile(UNITS)

        def work(columns):
            names, texts = columns["key"].to_pylist(), columns["text"].to_pylist()
            for a, b in portions(texts, CHUNK):
                found = zip(*(transform(t or "", draws(seed, k), units) for k, t in zip(names[a:b], texts[a:b])))
                yield {f"c{i}": columns[f"c{i}"].slice(a, b - a) for i in range(len(rest))} | {m.name: list(v) for m, v in zip(made, found)}

        return work

    inner = [T.StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(rest)]
    out = map_columns(rows, make, T.StructType(inner + made))
    return out.select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(rest)], *[m.name for m in made])


def restore(df: DataFrame, output: str = "output", form: str = "form", out: str = "restored") -> DataFrame:
    """Every row with the exact text rebuilt from output and form alone; a null output gives null."""
    kept = [f for f in df.schema.fields if f.name != out]
    rows = df.select(*[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(kept)], F.col(f"`{output}`").alias("output"), F.col(f"`{form}`").alias("form"))

    def make():
        def work(columns):
            outputs, forms = columns["output"].to_pylist(), columns["form"].to_pylist()
            for a, b in portions(outputs, CHUNK):
                found = [None if o is None else restored_text(o, f) for o, f in zip(outputs[a:b], forms[a:b])]
                yield {f"c{i}": columns[f"c{i}"].slice(a, b - a) for i in range(len(kept))} | {"restored": found}

        return work

    inner = [T.StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(kept)]
    made = map_columns(rows, make, T.StructType([*inner, T.StructField("restored", T.StringType())]))
    return made.select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(kept)], F.col("restored").alias(out))
