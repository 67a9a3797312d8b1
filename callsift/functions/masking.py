"""Personal-data masking with native regular expressions, and the compliance decision."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions.once import let
from callsift.functions.text import prohibited_test

_MOBILE = 4

# Per rule: a cheap test that every text with a match passes, and what the first character of a match looks like.
# They only save work: most texts fail the test, and a look-ahead spares the word-boundary test at most positions.
_TESTS: list[Callable[[Column], Column] | None] = [
    lambda text: F.contains(text, F.lit("DE")),
    None,
    lambda text: F.contains(text, F.lit("@")),
    None,
    None,
    lambda text: text.rlike(r"(?U)\d{5}\s"),
    None,
]
_STARTS = [None, r"\d", None, r"\d", "[+0]", None, r"\d"]


def _may_match(text: Column) -> Column:
    """A match of any rule has an '@' or three digits with nothing but spaces and hyphens between them."""
    return F.contains(text, F.lit("@")) | text.rlike(r"(?U)\d[ -]*\d[ -]*\d")


def mask_rules(strict: bool = False) -> list[tuple[str, str]]:
    """The seven rules in order; `strict` also masks `+49` numbers that follow a space."""
    rules = list(V.MASK_RULES)
    if strict:
        rules[_MOBILE] = (V.STRICT_MOBILE, rules[_MOBILE][1])
    return rules


def apply_rules(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """The rules one after the other, with nothing spared."""
    return reduce(lambda t, rule: F.regexp_replace(t, rule[0], rule[1]), rules, text)


def _spared(strict: bool) -> list[tuple[str, str, Callable[[Column], Column] | None]]:
    """(pattern, replacement, test) with the look-ahead put behind the flags of the pattern."""
    rows = []
    for (pattern, mark), test, start in zip(mask_rules(strict), _TESTS, _STARTS):
        flags, body = pattern.split(")", 1)
        rows.append((f"{flags})(?={start}){body}" if start else pattern, mark, test))
    return rows


def mask_pii(text: Column, strict: bool = False) -> Column:
    """Apply the rules in order, each to the result of the one before; null stays null."""

    def step(masked: Column, rule: tuple) -> Column:
        pattern, mark, test = rule
        if test is None:
            return F.regexp_replace(masked, pattern, mark)
        return let(masked, lambda t: F.when(test(t), F.regexp_replace(t, pattern, mark)).otherwise(t))

    return let(text, lambda t: F.when(_may_match(t), reduce(step, _spared(strict), t)).otherwise(t))


def is_pii_present(text: Column, strict: bool = False) -> Column:
    """Whether masking would change the text, that is whether any rule matches it as it stands."""
    found = [test(text) & text.rlike(pattern) if test else text.rlike(pattern) for pattern, _, test in _spared(strict)]
    return _may_match(text) & reduce(or_, found)


def compliance_check(text: Column) -> Column:
    """`refuse` for personal data or a prohibited phrase, else `approve`."""
    return F.when(is_pii_present(text) | prohibited_test(text), "refuse").otherwise("approve")
