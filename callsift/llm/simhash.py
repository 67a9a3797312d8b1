"""SimHash near-duplicates found by covering locality-sensitive hashing: no pair within the radius is missed."""

from __future__ import annotations

import random

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.base import map_columns, rows_of, utf8
from callsift.llm.components import connected_components
from callsift.session import settle

BITS = 64
WORD = (1 << BITS) - 1
#: Larger buckets are divided by the masks of the next level; the last level leaves so few free bits that none is large.
BUCKET = 4096
LEVELS = 3


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Bit j is set if it is set in over half of the XXH64 values of the word shingles (repeats included)."""
    words = utf8(text).lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    last = max(1, len(words) - shingle + 1)
    stops = ends.tolist()[min(shingle, len(words)) - 1 :]
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, last, 65536):
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts[at : min(last, at + 65536)], stops[at : at + 65536])], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << j for j in np.flatnonzero(2 * ones > last).tolist())


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def covering_masks(radius: int, level: int = 0) -> list[int]:
    """2^(radius+1) - 1 masks such that any two words that differ in at most `radius` bits agree under one of them.

    Each bit position gets a non-zero vector of radius + 1 bits; mask v keeps the positions whose vector has an odd inner
    product with v. The vectors of `radius` positions cannot span the space, so some v is orthogonal to all of them.
    """
    deal = [1 + i % ((1 << radius + 1) - 1) for i in range(BITS)]
    random.Random(level).shuffle(deal)
    return [sum(1 << i for i, x in enumerate(deal) if (x & v).bit_count() & 1) for v in range(1, 1 << radius + 1)]


def links_within(values: np.ndarray, nodes: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """For each node of a bucket that is linked, an edge to the smallest node it can reach inside the bucket."""
    order = np.argsort(nodes, kind="stable")
    values, nodes = values[order], nodes[order]
    left, found = np.arange(len(values)), []
    while len(left) > 1:
        root, front, left = nodes[left[0]], [left[0]], left[1:]
        while front and len(left):
            near = np.bitwise_count(values[left] ^ values[front.pop()]) <= radius
            if near.any():
                new = left[near]
                front += new.tolist()
                found += [(int(x), int(root)) for x in nodes[new]]
                left = left[~near]
    return found


def bucket_links(points: DataFrame, radius: int, bucket: int = BUCKET, levels: int = LEVELS) -> DataFrame:
    """Edges u, v between the nodes of `points` (fp long, node long; fps distinct) that join all pairs within the radius.

    Buckets of over `bucket` fingerprints are divided by the masks of the next level, which again keep every pair within
    the radius together somewhere. At the last level the free bits bound the size of a bucket. Inside a bucket only a
    spanning forest is put out, never all pairs.
    """
    edges = None
    keyed = points.select("fp", "node", F.lit(0).alias("path"), F.lit(0).cast("long").alias("kept"))
    for level in range(levels):
        masks = F.array(*[F.lit(signed(m)) for m in covering_masks(radius, level)])
        keyed = keyed.select("fp", "node", "path", "kept", F.posexplode(masks).alias("mask_id", "mask"))
        keyed = keyed.select("fp", "node", (F.col("path") * F.size(masks) + F.col("mask_id")).alias("path"), F.col("kept").bitwiseOR(F.col("mask")).alias("kept"))
        keyed = keyed.withColumn("part", F.col("fp").bitwiseAND(F.col("kept")))
        if level + 1 < levels:
            large = settle(keyed.groupBy("path", "part").count().where(F.col("count") > bucket).select("path", "part"), "buckets")
            some = not large.isEmpty()
            ready = keyed.join(large, ["path", "part"], "left_anti") if some else keyed
        else:
            some, ready = False, keyed

        def make():
            def work(columns):
                found = []
                for row in columns["points"].to_pylist():
                    if len(row) == 2:
                        if ((row[0]["fp"] ^ row[1]["fp"]) & WORD).bit_count() <= radius:
                            found.append((row[0]["node"], row[1]["node"]))
                    else:
                        found += links_within(
                            np.array([x["fp"] for x in row], np.int64).view(np.uint64), np.array([x["node"] for x in row], np.int64), radius
                        )
                return {"u": [x for x, _ in found], "v": [y for _, y in found]}

            return work

        groups = ready.groupBy("path", "part").agg(F.collect_list(F.struct("fp", "node")).alias("points")).where(F.size("points") > 1)
        found = map_columns(groups.select("points"), make, "u long, v long")
        edges = found if edges is None else edges.unionByName(found)
        if not some:
            break
        keyed = keyed.join(large, ["path", "part"], "left_semi").drop("part")
    return edges


def simhash_components(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """key, fingerprint (16 hexadecimal digits), component_id: the smallest key that links of at most `radius` bits reach.

    One row per input row. Null or blank texts have fingerprint zero and link like others. Equal fingerprints are one
    node, so copies cost nothing beyond their row. Rows with a null key take part but name no component.
    """

    def make():
        return lambda columns: {
            "key": columns["key"],
            "fp": [signed(fingerprint(x, shingle)) for (x,) in rows_of(columns, ("text",))],
        }

    kind = df.schema[key].dataType.simpleString()
    prints = settle(map_columns(df.select(F.col(key).alias("key"), F.col(text).alias("text")), make, f"key {kind}, fp long"), "prints")
    points = settle(prints.groupBy("fp").agg(F.min("key").cast("long").alias("node")), "points")
    found = connected_components(bucket_links(points.where("node IS NOT NULL"), radius))
    classes = points.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(settle(classes, "classes"), "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component_id").cast(kind)
    )
