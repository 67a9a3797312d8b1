"""Repeated substrings across a corpus: shard Burrows-Wheeler transforms merged by interleave refinement.

Every window of `length` bytes is filed under the smallest hash of the short strings in it, so that equal windows are
filed alike. Runs of neighbouring windows under one hash are a context. Contexts under a hash that occurs once cannot
hold a repeat; contexts that are equal as a whole need one comparison of hashes. What is left, different contexts under
one hash, goes to the transforms; where one hash has very many of them, they are first filed again under other hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsift.llm.base import map_columns, portions, rows_of, slices, utf8
from callsift.operators.ids import number_by_key
from callsift.session import settle

LENGTH = 100
#: Bytes of the short strings whose smallest hash files a window.
SEED = 24
#: Contexts, in bytes: of a bucket that one task merges, of a shard in it, and of one hash, filed twice, beyond which its windows
#: are compared one by one.
BUCKET, SHARD, HOT = 1 << 19, 1 << 17, 1 << 20
#: Bytes of texts that are hashed at once, about: few calls for short texts, and arrays that stay in the cache.
STRETCH = 1 << 15
#: Bits of the filter that spares the exact join most hashes without a repeat; fixed, so that its broadcast never grows.
FILTER_BITS = 28
#: Makes the hashes of the second filing differ from those of the first.
SALT = 0x5851F42D4C957F2D

_TABLE = np.random.default_rng(17).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_B = [pow(0x9E3779B97F4A7C15, 1 << i, 1 << 64) for i in range(6)]


def seed_hashes(data: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Mixed polynomial hash of every `size`-byte string, by doubling. Another salt gives another order."""
    power, width, done, total = _TABLE[data], 1, None, 0
    level = 0
    while True:
        if size >> level & 1:
            if done is None:
                done, total = power, width
            else:  # done covers the bytes before
                done = done[: len(power) - total] * np.uint64(pow(_B[0], width, 1 << 64)) + power[total:][: len(done)]
                total += width
        if total == size:
            break
        power = power[:-width] * np.uint64(pow(_B[0], width, 1 << 64)) + power[width:]
        width, level = 2 * width, level + 1
    done = done ^ (done >> np.uint64(32)) ^ np.uint64(salt)
    done = done * np.uint64(0xD6E8FEB86659FD93)
    return done ^ (done >> np.uint64(29))


def sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    width = 1
    while 2 * width <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return np.minimum(values[: len(values) - (size - width)], values[size - width :]) if size > width else values


def filed_windows(data: bytes, length: int, seed: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The hash that each window of the data is filed under, and those that the data has short strings of at several places."""
    hashes, width = seed_hashes(np.frombuffer(data, np.uint8), seed, salt), length - seed + 1
    filed = sliding_minimum(hashes, width)
    chosen = np.sort(hashes[smallest_somewhere(hashes, filed, width)])
    return filed, np.unique(chosen[1:][chosen[1:] == chosen[:-1]])


def smallest_somewhere(hashes: np.ndarray, filed: np.ndarray, width: int) -> np.ndarray:
    """Which places hold the smallest hash of a window; a window filed under 0 counts as none."""
    edge = np.zeros(width - 1, np.uint64)  # a place is the smallest of a window if no window over it has a larger minimum
    return hashes == ~sliding_minimum(~np.concatenate([edge, filed, edge]), width)


def contexts(texts: list[bytes], length: int = LENGTH, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """text (its place in the list), hash, start in it, byte length and `twice` of each context of some texts, in their order.

    twice: the text has short strings of that hash at several places, so that the context may repeat a part of itself.
    The texts are hashed end to end; windows over a border are left out.
    """
    some = [i for i, t in enumerate(texts) if len(t) >= length]
    if not some:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    sizes = np.array([len(texts[i]) for i in some])
    begin = np.cumsum(sizes) - sizes
    hashes, width = seed_hashes(np.frombuffer(b"".join(texts[i] for i in some), np.uint8), seed), length - seed + 1
    hashes = np.maximum(hashes, np.uint64(1))  # 0 is for windows over a border
    filed = sliding_minimum(hashes, width)
    for end in (begin[1:] - length + 1).tolist():
        filed[end : end + length - 1] = 0
    places = np.flatnonzero(smallest_somewhere(hashes, filed, width))
    mark = np.arange(len(some), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # tells equal hashes of different texts apart
    chosen = np.sort(hashes[places] ^ mark[np.searchsorted(begin, places, side="right") - 1])
    again = chosen[1:][chosen[1:] == chosen[:-1]]
    starts = np.flatnonzero(np.concatenate([[True], filed[1:] != filed[:-1]]))
    ends = np.append(starts[1:], len(filed))
    real = filed[starts] > 0
    starts, ends = starts[real], ends[real]
    owner = np.searchsorted(begin, starts, side="right") - 1
    twice = np.isin(filed[starts] ^ mark[owner], again) if len(again) else np.zeros(len(starts), bool)
    return np.array(some)[owner], filed[starts], starts - begin[owner], ends - starts + length - 1, twice


def filed_again(data: bytes, wanted: list, length: int, seed: int, salt: int) -> tuple[np.ndarray, ...]:
    """hash, start, byte length and `twice` of the parts of the wanted contexts (hash, at, n, twice) under other hashes too."""
    filed, again = filed_windows(data, length, seed, salt)
    wanted = sorted(wanted, key=lambda w: w["at"])
    at, n = np.array([w["at"] for w in wanted]), np.array([w["n"] for w in wanted]) - length + 1
    owner = np.repeat(np.arange(len(at)), n)
    window = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + at[owner]
    under = filed[window]
    first = np.flatnonzero(np.concatenate([[True], (under[1:] != under[:-1]) | (owner[1:] != owner[:-1])]))
    sizes = np.diff(np.append(first, len(owner))) + length - 1
    old = np.array([w["hash"] for w in wanted], np.int64).view(np.uint64)[owner[first]]
    twice = np.array([w["twice"] for w in wanted], bool)[owner[first]] & np.isin(under[first], again)
    return old * np.uint64(0x9E3779B97F4A7C15) ^ under[first], window[first], sizes, twice


def suffix_array(strings: list[bytes]) -> np.ndarray:
    """Suffixes in order of strings that each end in a mark of their own, by doubling."""
    m = len(strings)
    sizes = np.array([len(s) for s in strings])
    ends = np.cumsum(sizes + 1) - 1
    n = int(ends[-1]) + 1
    symbols = np.zeros(n, np.int64)
    inner = np.ones(n, bool)
    inner[ends] = False
    symbols[inner] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + m
    symbols[ends] = np.arange(m)
    rank, width = np.zeros(n, np.int64), 4 if (m + 256) ** 4 < 1 << 62 else 1  # the first order is by so many symbols at once
    for i in range(width):
        rank *= m + 256
        rank[: max(n - i, 0)] += symbols[i:]
    order = np.argsort(rank)
    while True:
        in_order = rank[order]
        new = np.concatenate([[0], np.cumsum(in_order[1:] != in_order[:-1])])
        if new[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new
        key = rank * (n + 1)
        key[: max(n - width, 0)] += rank[width:] + 1
        order, rank, width = np.argsort(key), key, 2 * width


def block_symbols(strings: list[bytes], depth: int) -> tuple[np.ndarray, int]:
    """Rank of the `step` symbols from each place on (0: a string's end and what is behind it), and the step.

    The step is the largest of 10, 5, 4, 2 and 1 that divides `depth`.
    """
    step = next(s for s in (10, 5, 4, 2, 1) if depth % s == 0)
    plain = np.frombuffer(b"".join(s + b"\0" for s in strings), np.uint8).astype(np.int64) + 1
    ends = np.cumsum([len(s) + 1 for s in strings]) - 1
    plain[ends] = 0
    left = np.repeat(ends, np.diff(np.append(-1, ends))) - np.arange(len(plain))
    width = min(step, 5)
    packed = np.zeros(len(plain), np.int64)
    for i in range(width):
        packed = packed * 257
        packed[: len(plain) - i] += np.where(left[: len(plain) - i] > i, plain[i:], 0)
    ranks = np.unique(packed, return_inverse=True)[1]
    if step > width:
        pairs = ranks * (len(plain) + 1)
        pairs[:-width] += np.where(left[:-width] >= width, ranks[width:], 0)
        ranks = np.unique(pairs, return_inverse=True)[1]
    return ranks.astype(np.uint32), step


def merge_transforms(shards: list[tuple[np.ndarray, np.ndarray]], tails: np.ndarray, tail_shard: np.ndarray, depth: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Merged order of all suffixes by their first `depth` symbols, as (shard of each place, common prefix with the place before).

    shards: for each suffix in the shard's order, the rank of the `step` symbols before it, and whether its string has so
    many before it. tails, tail_shard: ranks and shards of the suffixes of under `step` symbols, which have no suffix
    behind them, string by string.

    Interleave refinement: when places are in order by h symbols, dealing them stably by the `step` symbols before each
    suffix puts the suffixes that begin with those in order by h + step. Only shard numbers move; each shard's own order
    is never sorted again. A border between two places that first shows in round r means a common prefix of at least
    (r - 1) * step and under r * step symbols (the former is given); without a border it is `depth` or more.
    """
    symbols = np.concatenate([s for s, _ in shards])
    whole = np.concatenate([w for _, w in shards])
    kind = np.uint8 if len(shards) <= 256 else np.uint16
    source = np.repeat(np.arange(len(shards), dtype=kind), [len(s) for s, _ in shards])
    tail_shard = tail_shard.astype(kind)
    n, m = len(symbols), len(tails)
    block = np.zeros(n, np.int32)
    common = np.full(n, depth, np.int32)
    border = np.zeros(n, bool)
    for h in range(0, depth, step):
        by_shard = np.argsort(source, kind="stable")
        before, real = np.empty(n, np.uint32), np.empty(n, bool)
        before[by_shard], real[by_shard] = symbols, whole
        some = np.flatnonzero(real)
        key = np.concatenate([tails, before[some]])
        order = np.sort(key.astype(np.uint64) << np.uint64(32) | np.arange(len(key), dtype=np.uint64)).astype(np.uint32)  # equal ones as they were
        moved = np.concatenate([tail_shard, source[some]])[order]
        key = key[order]
        part = np.concatenate([np.arange(-m, 0, dtype=np.int32), block[some]])[order]  # a tail is like no other suffix
        now = np.ones(n, bool)
        now[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
        fresh = now & ~border
        common[fresh] = h
        if not fresh.any() and np.array_equal(moved, source):
            break
        source, border = moved, now
        block = np.cumsum(now, dtype=np.int32)
    return source, common


def later_windows(strings: list[bytes], length: int = LENGTH, shard: int = SHARD) -> list[np.ndarray]:
    """For strings in corpus order: offsets in each at which a window starts that starts earlier, too."""
    groups, size = [[]], 0
    for s in strings:
        if size + len(s) > shard and groups[-1]:
            groups.append([])
            size = 0
        groups[-1].append(s)
        size += len(s) + 1
    orders = [suffix_array(g) for g in groups]
    bases = np.cumsum([0, *map(len, orders)])[:-1]
    ranks, step = block_symbols(strings, length)
    ends = np.cumsum([len(s) + 1 for s in strings]) - 1
    begin = np.repeat(np.append(0, ends[:-1] + 1), [len(s) + 1 for s in strings])
    shards = []
    for order, base in zip(orders, bases):
        at = order + base - step
        shards.append((ranks[np.maximum(at, 0)], at >= begin[order + base]))
    least = [max(len(s) + 1 - step, 0) for s in strings]
    tails = np.concatenate([np.arange(e - len(s) + a, e + 1) for s, e, a in zip(strings, ends, least)])
    tail_shard = np.searchsorted(bases, tails, side="right") - 1
    source, common = merge_transforms(shards, ranks[tails], tail_shard, length, step)
    place = np.empty(len(source), np.int64)
    place[np.argsort(source, kind="stable")] = np.concatenate([sa + b for sa, b in zip(orders, bases)])
    sizes = np.array([len(s) for s in strings])
    firsts = np.cumsum(sizes + 1) - sizes - 1
    window = np.zeros(len(source), bool)
    for a, n in zip(firsts.tolist(), sizes.tolist()):
        window[a : a + n - length + 1] = True
    # places of one interval share `length` symbols; strings and offsets rise with the place in the text
    interval = np.cumsum(common < length)
    some = window[place]
    place, interval = place[some], interval[some]
    least = np.full(interval.max(initial=0) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, interval, place)
    later = np.sort(place[place != least[interval]])
    cuts = np.searchsorted(later, firsts)
    return [later[a:b] - f for a, b, f in zip(cuts, [*cuts[1:], len(later)], firsts)]


def runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """(start, bytes) of the runs of neighbouring window starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) != 1)
    first, last = starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)]
    return list(zip(first.tolist(), (last - first + length).tolist()))


PLACE = ["doc", "key", "at"]


def later_occurrences(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(later, first): of the rows with equal `keys`, the first by place and all others. `rows` is a written table.

    The first is found by a partial aggregation; both sides of the join are written tables, so that AQE can split a key
    that very many rows share, or broadcast the firsts where their written size allows.
    """
    first = rows.groupBy(*keys).agg(F.min(F.struct(*PLACE, *[c for c in rows.columns if c not in (*keys, *PLACE)])).alias("first"))
    first = settle(first.select(*keys, "first.*"), "firsts")
    named = first.select(*keys, *[F.col(x).alias(f"_{x}") for x in PLACE])
    same = (F.col("doc") == F.col("_doc")) & (F.col("key") == F.col("_key")) & (F.col("at") == F.col("_at"))
    return rows.join(named, keys).where(~same).select(*PLACE, "n"), first


def repeated_hashes(filed: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Hashes that occur at least twice, and a filter of fixed size that lets all of them pass (and some others)."""
    repeated = settle(filed.groupBy("hash").count().where(F.col("count") > 1).select("hash"), "hashes")
    words = repeated.selectExpr(f"shiftright(hash & {(1 << FILTER_BITS) - 1}, 5) AS word", "shiftleft(1L, CAST(hash & 31 AS INT)) AS bit")
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(1 << FILTER_BITS - 5, np.uint32)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    return repeated, bits


def repeated_spans(docs: DataFrame, length: int = LENGTH, bucket: int = BUCKET, hot: int = HOT) -> DataFrame:
    """doc, key, spans (array of at, n): byte ranges covered by windows that start earlier in the corpus.

    `docs` has doc (long, the order of documents), key (long, tells texts with one doc apart) and text; windows of texts
    with equal doc are in the order of key. Rows that repeat doc and text are one document.
    """
    spark = docs.sparkSession
    seed = min(SEED, max(1, length // 2))

    def hashes_only():
        def work(columns):
            for some in slices(columns):
                data = [utf8(t) for t in some["text"].to_pylist()]
                found = [contexts(data[a:b], length, seed) for a, b in portions(data, STRETCH)]
                yield {"hash": np.concatenate([x for f in found for x in (f[1], f[1][f[4]])]).view(np.int64)}

        return work

    repeated, bits = repeated_hashes(map_columns(docs.select("text"), hashes_only, "hash long"))
    shared = spark.sparkContext.broadcast(bits)

    def occurrences():
        known = shared.value

        def work(columns):
            for some in slices(columns):
                data = [utf8(t) for t in some["text"].to_pylist()]
                for a, b in portions(data, STRETCH):
                    yield found_in(data[a:b], some["doc"].slice(a, b - a).to_numpy(), some["key"].slice(a, b - a).to_numpy())

        def found_in(texts, doc, key):
            owner, found, at, n, twice = contexts(texts, length, seed)
            slot = found & np.uint64((1 << FILTER_BITS) - 1)
            keep = np.flatnonzero(known[slot >> np.uint64(5)] >> (slot & np.uint64(31)).astype(np.uint32) & np.uint32(1))
            owner, at, n = owner[keep], at[keep], n[keep]
            views = [memoryview(t) for t in texts]
            whole = [xxhash.xxh3_64_intdigest(views[i][a : a + b]) for i, a, b in zip(owner.tolist(), at.tolist(), n.tolist())]
            columns = (found[keep].view(np.int64), np.array(whole, np.uint64).view(np.int64), doc[owner], key[owner], at.astype(np.int32), n.astype(np.int32), twice[keep])
            return {x: pa.array(v) for x, v in zip(("hash", "whole", "doc", "key", "at", "n", "twice"), columns)}

        return work

    place = "doc long, key long, at int, n int"
    all_rows = map_columns(docs.select("doc", "key", "text"), occurrences, f"hash long, whole long, {place}, twice boolean")
    rows = settle(all_rows.join(repeated, "hash"), "contexts")
    later, first = later_occurrences(rows, ["hash", "whole"])
    many = F.count("*").alias("different"), F.sum("n").alias("bytes"), F.max("twice").alias("twice")
    sizes = settle(first.groupBy("hash").agg(*many).where("different > 1 OR twice").select("hash", "bytes"), "sizes")
    again = F.collect_list(F.struct("hash", "bytes", "at", "n", "twice")).alias("wanted")
    wanted = settle(first.join(sizes, "hash").groupBy("doc", "key").agg(again), "wanted")

    def extract():
        """The bytes of the contexts: as they are, or (with `whole`) filed again where their hash is hot."""

        def work(columns):
            out = {x: [] for x in ("hash", "whole", "doc", "key", "at", "n", "twice", "data")}
            for doc, key, text, some in rows_of(columns, ("doc", "key", "text", "wanted")):
                data = utf8(text)
                rows = [(w["hash"], None, w["at"], w["n"], None) for w in some if w["bytes"] <= hot]
                hottest = [w for w in some if w["bytes"] > hot]
                if hottest:
                    found, at, n, twice = filed_again(data, hottest, length, seed, SALT)
                    whole = np.array([xxhash.xxh3_64_intdigest(data[a : a + b]) for a, b in zip(at.tolist(), n.tolist())], np.uint64)
                    rows += zip(found.view(np.int64).tolist(), whole.view(np.int64).tolist(), at.tolist(), n.tolist(), twice.tolist())
                for hashed, whole, at, n, twice in rows:
                    for x, v in zip(out, (hashed, whole, doc, key, at, n, twice, data[at : at + n])):
                        out[x].append(v)
                if len(out["doc"]) > 20_000:
                    yield out
                    out = {x: [] for x in out}
            yield out

        return work

    texts = docs.join(wanted, ["doc", "key"]).select("doc", "key", "text", "wanted")
    parts = settle(map_columns(texts, extract, f"hash long, whole long, {place}, twice boolean, data binary"), "parts")
    cold, refiled = parts.where("whole IS NULL"), parts.where("whole IS NOT NULL")
    same, first = later_occurrences(refiled.drop("data"), ["hash", "whole"])
    sizes = settle(first.groupBy("hash").agg(*many).where("different > 1 OR twice").select("hash", "bytes"), "sizes")
    left = settle(first.join(sizes, "hash").select("hash", "bytes", *PLACE, "n"), "left")
    pieces = settle(refiled.select(*PLACE, "data").join(left.drop("n"), PLACE), "pieces")
    spare = pieces.where(F.col("bytes") <= hot)
    size = F.coalesce(F.sum("n"), F.lit(0))
    total = cold.agg(size).first()[0] + left.where(F.col("bytes") <= hot).agg(size).first()[0]
    into = F.pmod("hash", F.lit(max(32, -(-total // bucket)))).cast("int").alias("bucket")

    def every_window():
        def work(columns):
            for doc, key, at, data in zip(*(columns[x].to_pylist() for x in (*PLACE, "data"))):
                for first in range(0, len(data) - length + 1, 1 << 16):
                    size = min(1 << 16, len(data) - length + 1 - first)
                    digests = [xxhash.xxh3_128_intdigest(data[i : i + length]) for i in range(first, first + size)]
                    yield {
                        "one": [(x >> 64) - (1 << 63) for x in digests], "two": [(x & (1 << 64) - 1) - (1 << 63) for x in digests],
                        "doc": [doc] * size, "key": [key] * size, "at": list(range(at + first, at + first + size)), "n": [length] * size,
                    }

        return work

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(set(zip(*(table.column(x).to_pylist() for x in (*PLACE, "data")))))
        found = [(doc, key, at + a, n) for (doc, key, at, _), later in zip(rows, later_windows([r[3] for r in rows], length)) for a, n in runs(later, length)]
        return pa.table({x: pa.array([f[i] for f in found], t) for i, (x, t) in enumerate(zip((*PLACE, "n"), (pa.int64(), pa.int64(), pa.int32(), pa.int32())))})

    shared_out = [x.select(into, *PLACE, "data") for x in (cold, spare)]
    merged = shared_out[0].unionByName(shared_out[1]).groupBy("bucket").applyInArrow(merge, place)
    windows = settle(map_columns(pieces.where(F.col("bytes") > hot).select(*PLACE, "data"), every_window, f"one long, two long, {place}"), "windows")
    single, _ = later_occurrences(windows, ["one", "two"])
    spans = later.unionByName(same).unionByName(merged).unionByName(single)
    return spans.groupBy("doc", "key").agg(F.collect_list(F.struct("at", "n")).alias("spans"))


def cut_spans(data: bytes, spans: list | None) -> tuple[bytes, int, int]:
    """Remaining bytes, removed bytes and number of maximal removed runs."""
    if not spans:
        return data, 0, 0
    kept, at, removed, count, end = [], 0, 0, 0, -1
    for start, n in sorted((s["at"], s["n"]) for s in spans):
        if start > end:
            count += 1
            kept.append(data[at:start])
            end = start
        if start + n > end:
            removed += start + n - end
            end = start + n
        at = end
    kept.append(data[at:])
    return b"".join(kept), removed, count


def document_keys(df: DataFrame, key: str, text: str) -> DataFrame:
    """The columns of df as c0, c1, ..., with doc (its key, null ones last), key and text.

    doc and key name a text: key is 0 where a doc is in one row only, else the number of the text among the different ones
    in such rows, in order of doc and digest. Numbers come from a range sort, so that a key may hold any share of the rows.
    """
    order = F.coalesce(F.col(f"`{key}`").cast("long"), F.lit((1 << 63) - 1)).alias("doc")
    named = df.select(*[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(df.columns)], order, F.col(f"`{text}`").alias("text"))
    again = settle(named.groupBy("doc").count().where("count > 1").select("doc"), "repeated-ids")
    if again.isEmpty():
        return named.withColumn("key", F.lit(0).cast("long"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")
    texts = named.join(again, "doc", "left_semi").select("doc", digest).distinct()
    numbers = settle(number_by_key(texts, ["doc", "digest"], "key", start=1), "numbers")
    return named.withColumn("digest", digest).join(numbers, ["doc", "digest"], "left").withColumn("key", F.coalesce("key", F.lit(0).cast("long"))).drop("digest")


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Every row with n_bytes, n_removed, n_spans, kept (binary) and kept_text: its text without bytes that a repeat covers.

    A byte goes if it lies in a string of `length` bytes that also starts earlier: in a row with a smaller key, or earlier
    in the same row. Strings are judged on the input. Rows with equal key and different texts are in an order of their
    text's digest; rows that repeat key and text are one document and get one result; null keys come last. Null text is
    empty, an empty table gives no row. kept_text leaves out bytes that no longer make up a character. Other columns, of
    any name, pass through (those named like results are replaced).
    """
    made = T._parse_datatype_string("n_bytes long, n_removed long, n_spans long, kept binary, kept_text string")
    rest = [(f"c{i}", f) for i, f in enumerate(df.schema.fields) if f.name not in made.names]
    named = document_keys(df, key, text)
    spans = settle(repeated_spans(named.select("doc", "key", "text"), length), "spans")

    def make():
        def work(columns):
            for some in slices(columns):
                data = [utf8(t) for t in some["text"].to_pylist()]
                kept, removed, count = zip(*map(cut_spans, data, some["spans"].to_pylist()))
                left = [k.decode("utf-8", "ignore") for k in kept]
                found = {"n_bytes": list(map(len, data)), "n_removed": list(removed), "n_spans": list(count), "kept": list(kept), "kept_text": left}
                yield {name: some[name] for name, _ in rest} | found

        return work

    joined = named.join(spans, ["doc", "key"], "left").select(*[name for name, _ in rest], "text", "spans")
    out = map_columns(joined, make, T.StructType([T.StructField(name, f.dataType, f.nullable) for name, f in rest] + made.fields))
    return out.select(*[F.col(name).alias(f.name) for name, f in rest], *made.names)
