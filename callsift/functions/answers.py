"""Gold mappers, answer parsers and raw-response columns. All are native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions.jsontext import OPTIONS, is_json, json_at, value_at
from callsift.functions.once import let
from callsift.functions.text import strip

# --- gold mappers ---------------------------------------------------------------------------


def _tidy(text: Column) -> Column:
    return F.lower(strip(text))


def _has(text: Column, word: str) -> Column:
    return F.contains(text, F.lit(word))


def gold_plain(output: Column) -> Column:
    return _tidy(F.coalesce(output, F.lit("")))


def gold_exact(output: Column) -> Column:
    return strip(F.coalesce(output, F.lit("")))


def gold_de(output: Column) -> Column:
    """German labels: `betrug` without `kein`."""
    text = gold_plain(output)
    return F.when(_has(text, "betrug") & ~_has(text, "kein"), "fraud").otherwise("legitimate")


def gold_de_simple(output: Column) -> Column:
    return F.when(_has(F.lower(output), "betrug"), "fraud").otherwise("legitimate")


def gold_normalized(output: Column) -> Column:
    return parse_fraud_first(output)


# --- answer parsers: null (no answer) stays null ----------------------------------------------


def _first_label(text: Column) -> Column:
    """First whole-word label, null when there is none."""
    return F.nullif(F.regexp_extract(text, r"(?U)\b(fraud|legitimate)\b", 1), F.lit(""))


def _only(answer: Column, legit_mark: str, fraud_mark: str, fallback: Column) -> Column:
    """A label named alone wins; else the first whole-word label; else the fallback."""
    text = _tidy(answer)
    fraud, legit = _has(text, "fraud"), _has(text, "legitimate")
    return (
        F.when(_has(text, legit_mark) & ~fraud, "legitimate")
        .when(_has(text, fraud_mark) & ~legit, "fraud")
        .when(answer.isNotNull(), F.coalesce(_first_label(text), fallback))
    )


def parse_contains_raw(answer: Column) -> Column:
    return _only(answer, "legitimate", "fraud", _tidy(answer))


def parse_contains(answer: Column) -> Column:
    return _only(answer, "legitimate", "fraud", F.lit("unknown"))


def parse_result_tag(answer: Column) -> Column:
    return _only(answer, "result: legitimate", "result: fraud", F.lit("unknown"))


def parse_fraud_first(answer: Column) -> Column:
    text = _tidy(answer)
    return (
        F.when(_has(text, "fraud"), "fraud")
        .when(_has(text, "legitimate"), "legitimate")
        .when(answer.isNotNull(), "unparsed")
    )


def parse_binary(answer: Column) -> Column:
    text = _tidy(F.substring_index(answer, V.RESPONSE_HEAD, -1))
    return F.when(_has(text, "fraud"), "fraud").when(answer.isNotNull(), "legitimate")


def parse_with_confidence(answer: Column, legit_word: str = "legit") -> Column:
    """STRUCT<label, confidence>; blank and missing answers are unknown. A hit on 'legit' is labelled `legit_word`."""
    text = _tidy(F.coalesce(answer, F.lit("")))
    label = F.when(_has(text, "fraud"), "fraud").when(_has(text, "legit"), legit_word).otherwise("unknown")
    sure = _has(text, "fraud") | _has(text, "legit")
    return F.struct(label.alias("label"), sure.cast("double").alias("confidence"))


def parse_judge(answer: Column) -> Column:
    return F.when(_has(F.lower(answer), "score: pass"), "PASS").when(answer.isNotNull(), "FAIL")


# --- raw responses ------------------------------------------------------------------------------


def unwrap_chat(raw: Column) -> Column:
    """Stripped text of a chat response, null when the response has none."""
    return strip(json_at(raw, ".choices[0].message.content", "string"))


def unwrap_completion(raw: Column) -> Column:
    return strip(json_at(raw, ".choices[0].text", "string"))


def unwrap_guarded(raw: Column) -> Column:
    """The `content` of a JSON object, else the whole value."""
    return F.coalesce(json_at(raw, ".content", "string"), raw)


def strip_fence(text: Column, multiline: bool = True) -> Column:
    """Drop Markdown code fences at line starts and ends, or only at the ends of the whole text."""
    flags = "(?mdU)" if multiline else "(?dU)"
    bare = F.regexp_replace(text, flags + V.FENCE, "")
    return F.when(_has(text, "```"), bare).otherwise(text)


def double_bad_backslashes(text: Column) -> Column:
    """Double every backslash that does not start a JSON escape."""
    doubled = F.regexp_replace(text, V.BAD_BACKSLASH, r"\\\\")
    return F.when(_has(text, "\\"), doubled).otherwise(text)


def clean_answer(raw: Column, missing_is_raw: bool = True) -> Column:
    """Transcript text of a generated answer.

    Not JSON: the cleaned text with backslashes turned into slashes. A JSON object without `text`: the raw answer, or
    '' for `missing_is_raw=False`. JSON whose text is no string, or that is no object: null, a failed attempt.
    """
    missing = raw if missing_is_raw else F.lit("")

    def text_of(clean: Column, fixed: Column) -> Column:
        return (
            F.when(~is_json(fixed), F.replace(clean, F.lit("\\"), F.lit("/")))
            .otherwise(let(F.from_json(fixed, "map<string,string>", OPTIONS), lambda values: of_object(values, fixed)))
        )

    def of_object(values: Column, fixed: Column) -> Column:
        return (
            F.when(values.isNull(), None)
            .when(~F.map_contains_key(values, "text"), missing)
            .otherwise(let(value_at(fixed, ".text", "variant"), _string))
        )

    return let(strip(strip_fence(raw)), lambda clean: let(double_bad_backslashes(clean), lambda f: text_of(clean, f)))


def _string(value: Column) -> Column:
    """A variant's text, null unless it is a string."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _whole_number(value: Column) -> Column:
    """A variant as a whole number: digit strings are read, numbers truncated, booleans are 0 or 1, else null."""
    kind, words = F.schema_of_variant(value), strip(F.try_variant_get(value, "$", "string"))
    return (
        F.when(kind == "STRING", F.when(words.rlike(r"^[+-]?\d+$"), words.try_cast("int")))
        .when(kind == "BOOLEAN", (words == "true").cast("int"))
        .otherwise(F.try_variant_get(value, "$", "double").try_cast("int"))
    )


def judge_score(raw: Column) -> Column:
    """Whole number at `score` in a JSON object; any failure gives 0."""
    text = strip_fence(strip(raw), multiline=False)
    return F.coalesce(let(json_at(text, ".score", "variant"), _whole_number), F.lit(0))
