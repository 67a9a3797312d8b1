"""Evaluate costly expressions and constants once, however often they are used."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once; inlining would compute it at every mention."""
    return F.element_at(F.transform(F.array(value), lambda known: use(known)), 1)


def literal_array(values: list, element: str) -> Column:
    """A constant array as one literal: Catalyst folds the parse away, and the plan is built with a single call."""
    return F.from_json(F.lit(json.dumps(values, default=str)), f"array<{element}>")


def choose(values: list, index: Column) -> Column:
    """The value at an index that counts from 0."""
    return F.element_at(literal_array(values, "string" if isinstance(values[0], str) else "int"), index + 1)


def pin(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add or replace a column so that later filters and projections read it and do not compute it again.

    Catalyst pushes a filter on a computed column below the projection, which computes the column twice. It does not
    push a filter below a generator, and a generator over a one-element array is a narrow, row-preserving step.
    """
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name)).select(
        *df.columns, *([] if name in df.columns else [name])
    )
