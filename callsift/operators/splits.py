"""Reproducible train / validation / test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions import draws
from callsift.session import settle

NAMES = ["train", "validation", "test"]
_DIGITS = 4  # hex digits per histogram level: at most 65536 counts reach the driver
_FEW = 65536


def split_sizes_for(rows: int, train: float = V.TRAIN_SHARE, validation: float = V.VALIDATION_SHARE) -> tuple[int, int]:
    """End positions of train and validation, truncated as IEEE doubles."""
    end = int(rows * train)
    return end, end + int(rows * validation)


def split_digest(seed: int | str, key: list[str]) -> Column:
    """Digest of a split key. Several columns are each written as length and value (null: -), so no two keys read alike."""
    if len(key) == 1:
        return draws.digest(seed, F.col(key[0]))
    parts = [F.coalesce(F.concat(F.length(k).cast("string"), F.lit(":"), k), F.lit("-")) for k in (F.col(c).cast("string") for c in key)]
    return draws.digest(seed, F.concat(*parts))


def seeded_shuffle(df: DataFrame, key: list[str], seed: int = V.SPLIT_SEED) -> DataFrame:
    """The rows in the reproducible random order of md5(seed, key): a distributed range sort.

    Rows with one key are ordered by content and equal rows by chance, so that a row that fills a third of the table is
    still cut into ranges; the order of equal rows does not matter.
    """
    return df.orderBy(split_digest(seed, key), F.xxhash64(*df.columns), F.rand(seed))


def _counts(keyed: DataFrame, prefix: str, digits: int) -> list[tuple[str, int]]:
    piece = F.substring("_order", len(prefix) + 1, digits)
    inside = keyed.where(F.startswith("_order", F.lit(prefix))) if prefix else keyed
    return sorted((r["p"], r["n"]) for r in inside.groupBy(piece.alias("p")).agg(F.count("*").alias("n")).collect())


def _walk(counts: list[tuple[str, int]], position: int) -> tuple[str, int, int]:
    """The piece that holds `position`, the position inside it and its size."""
    for piece, size in counts:
        if position < size:
            return piece, position, size
        position -= size
    raise ValueError("position is past the end")


def _find_cut(keyed: DataFrame, first: list[tuple[str, int]], position: int) -> tuple[str, int, int]:
    """(value, rest, size): the cut falls before row number `rest` of the `size` rows whose order starts with value.

    A distributed selection: histograms over digest prefixes narrow down to the cut, no row is moved. With rest 0 a
    prefix is enough, else the value is a whole digest.
    """
    prefix, rest, size = _walk(first, position)
    while rest and len(prefix) < 32:
        digits = 32 - len(prefix) if size <= _FEW else _DIGITS
        piece, rest, size = _walk(_counts(keyed, prefix, digits), rest)
        prefix += piece
    return prefix, rest, size


def _same_rows(keyed: DataFrame, value: str, shares: list[tuple[str, int]], chunk: int = 100_000) -> DataFrame:
    """The rows with one order value, as so many copies per split. Copies are made in chunks by many tasks."""
    columns = [c for c in keyed.columns if c != "_order"]
    distinct = keyed.where(F.col("_order") == value).groupBy(*columns).agg(F.count("*").alias("_copies"))
    if distinct.count() != 1:
        raise ValueError("different rows share the split key at a cut; name more columns in the key")
    plan = F.array(*[F.struct(F.lit(s).alias("split"), F.lit(n).cast("bigint").alias("_n")) for s, n in shares])
    chunks = distinct.select(*columns, F.inline(plan)).select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / chunk))).alias("_chunk")
    )
    size = F.least(F.lit(chunk), F.col("_n") - F.col("_chunk") * chunk)
    spread = chunks.repartition(F.col("split"), F.col("_chunk")) if sum(n for _, n in shares) > chunk else chunks
    return spread.withColumn("_one", F.explode(F.sequence(F.lit(1).cast("bigint"), size))).select(*columns, "split")


def with_order(df: DataFrame, key: list[str], seed: int = V.SPLIT_SEED) -> DataFrame:
    """Add `_order`, the digest that shuffles the rows. `key` must tell different rows apart."""
    return df.withColumn("_order", split_digest(seed, key))


def split_by_order(
    keyed: DataFrame, train: float = V.TRAIN_SHARE, validation: float = V.VALIDATION_SHARE
) -> DataFrame:
    """Turn `_order` into `split` with the exact sizes int(n*train), int(n*validation) and the rest.

    Two or three passes over the digests find those at the cuts; labelling is then a narrow comparison, so texts are
    never shuffled or sorted. Equal rows that straddle a cut are divided by count.
    """
    first = _counts(keyed, "", _DIGITS)
    rows = sum(n for _, n in first)
    positions = list(split_sizes_for(rows, train, validation))
    cuts = [_find_cut(keyed, first, p) if p < rows else None for p in positions]

    label: Column = F.lit(NAMES[-1])
    for name, cut in reversed(list(zip(NAMES, cuts))):
        label = F.lit(name) if cut is None else F.when(F.col("_order") < cut[0], name).otherwise(label)

    # Equal rows around a cut, as value -> (position of the first one, number of rows).
    divided = {cut[0]: (p - cut[1], cut[2]) for p, cut in zip(positions, cuts) if cut and cut[1]}
    plain = keyed.where(~F.col("_order").isin(list(divided))) if divided else keyed
    result = plain.withColumn("split", label).drop("_order")
    for value, (begin, size) in divided.items():
        edges = [begin, *[min(max(p, begin), begin + size) for p in positions], begin + size]
        shares = [(name, end - at) for name, at, end in zip(NAMES, edges, edges[1:]) if end > at]
        result = result.unionByName(_same_rows(keyed, value, shares))
    return result


def seeded_split_exact(
    df: DataFrame,
    key: list[str],
    seed: int = V.SPLIT_SEED,
    train: float = V.TRAIN_SHARE,
    validation: float = V.VALIDATION_SHARE,
) -> DataFrame:
    """Add `split` in md5(seed, key) order. The rows are written once with their digest; the passes read that column."""
    return split_by_order(settle(with_order(df, key, seed), "split"), train, validation)


def slice_split(df: DataFrame, rank: str, ends: tuple[int, int]) -> DataFrame:
    """Contiguous ranges of a rank that counts from 0."""
    place = F.col(rank)
    label = F.when(place < ends[0], NAMES[0]).when(place < ends[1], NAMES[1]).otherwise(NAMES[2])
    return df.withColumn("split", label)


def seeded_split_hash(
    df: DataFrame,
    key: list[str],
    seed: int = V.SPLIT_SEED,
    train: float = V.TRAIN_SHARE,
    validation: float = V.VALIDATION_SHARE,
) -> DataFrame:
    """Add `split` by a threshold on the draw: one pass, sizes are approximate."""
    draw = draws.uniform(split_digest(seed, key))
    label = F.when(draw < train, NAMES[0]).when(draw < train + validation, NAMES[1]).otherwise(NAMES[2])
    return df.withColumn("split", label)


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("rows"))


def _split_sets(df: DataFrame, text: str) -> DataFrame:
    """Which splits each text occurs in, as bits; only hashes are shuffled, after map-side combine."""
    bit = F.when(F.col("split") == NAMES[0], 1).when(F.col("split") == NAMES[1], 2).otherwise(4)
    return df.groupBy(F.md5(text).alias("_hashes")).agg(F.bit_or(bit).alias("bits"))


def leakage_check(df: DataFrame, text: str = "input") -> DataFrame:
    """Texts shared by each pair of splits, one row per pair; 0 everywhere means no leakage."""
    pairs = [("train", "validation", 3), ("train", "test", 5), ("validation", "test", 6)]
    both = [F.count_if(F.col("bits").bitwiseAND(F.lit(m)) == m).alias(f"_{m}") for _, _, m in pairs]
    rows = [
        F.struct(F.lit(a).alias("split_a"), F.lit(b).alias("split_b"), F.col(f"_{m}").alias("shared_texts"))
        for a, b, m in pairs
    ]
    return _split_sets(df, text).agg(*both).select(F.inline(F.array(*rows)))


def split_disjoint(df: DataFrame, text: str = "input") -> DataFrame:
    """One row: is every text in one split only?"""
    one = F.col("bits").isin(1, 2, 4)
    return _split_sets(df, text).agg(F.coalesce(F.bool_and(one), F.lit(True)).alias("disjoint"))
