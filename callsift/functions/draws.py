"""Draws that are a pure function of (seed, id), so retries and other partitionings give the same rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(seed: int | str, *key: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in key]))


def _hex_number(digest_column: Column, part: int) -> Column:
    """Eight hex digits of the digest as a number; parts 0 to 3 are independent."""
    return F.conv(F.substring(digest_column, 8 * part + 1, 8), 16, 10).cast("bigint")


def uniform(digest_column: Column, part: int = 0) -> Column:
    """A number in [0, 1)."""
    return _hex_number(digest_column, part) / F.lit(4294967296.0)


def pick(digest_column: Column, part: int, size: int) -> Column:
    """An index in 0 .. size-1."""
    return (_hex_number(digest_column, part) % F.lit(size)).cast("int")


def temperature(digest_column: Column, part: int = 0) -> Column:
    return F.round(F.lit(0.7) + uniform(digest_column, part) * F.lit(0.25), 2)
