"""Best-fit packing by bin completion: as few sequences as can be found, documents cut only where they are too long.

Bins care about lengths only, and there are at most `length` different ones. So the search runs over a histogram of that
fixed size, whatever the corpus; its result, a list of fillings with how often each is used, is broadcast, and every piece
finds its place from its rank among the pieces of its length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callsift.llm.base import map_columns, portions
from callsift.llm.bpe import CHUNK, vocabulary
from callsift.llm.piece_codec import piece_codec
from callsift.session import settle

LENGTH = 4096
END = 1
#: Steps of the whole search and of one node's enumeration; beyond them the best packing so far stands.
STEPS, OF_NODE = 600_000, 2_000

Filling = tuple[tuple[int, int], ...]  # (length, uses) of one bin, longest first


def least_bins(counts: np.ndarray) -> int:
    """Bins that no packing can do without: of all thresholds, the largest bound by items over half, over the rest, and between.

    counts[i] items have length i; the last index is the capacity.
    """
    capacity = len(counts) - 1
    number, size = np.cumsum(counts), np.cumsum(counts * np.arange(capacity + 1))
    half = capacity // 2
    small = np.arange(1, half + 1)
    beyond = number[-1] - number[capacity - small]  # no item of `small` or more fits beside these
    large = number[capacity - small] - number[half]
    room = large * capacity - (size[capacity - small] - size[half])
    middle = size[half] - size[small - 1]
    with_small = beyond + large + np.maximum(0, -(-(middle - room) // capacity))
    return int(max(-(-size[-1] // capacity), number[-1] - number[half], with_small.max(initial=0)))


def best_fit(counts: np.ndarray) -> list[tuple[int, Filling]]:
    """Best-fit decreasing on a histogram: bins of equal content are one entry (how many, content)."""
    capacity = len(counts) - 1
    open_bins: dict[int, Counter] = {capacity: Counter()}  # room left -> content -> bins
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        for room in sorted(r for r in open_bins if r >= length):
            if room == capacity:
                break
            uses, kinds = room // length, open_bins[room]
            for content in list(kinds):
                for each in (uses, left % uses if left < uses * kinds[content] else 0):
                    n = min(kinds[content], left // each) if each else 0
                    if n:
                        kinds[content] -= n
                        left -= n * each
                        open_bins.setdefault(room - each * length, Counter())[(*content, (length, each))] += n
                kinds += Counter()
                if not left:
                    break
            if not left:
                break
        uses = capacity // length
        for each, n in ((uses, left // uses), (left % uses, 1)):
            if each and n:
                open_bins.setdefault(capacity - each * length, Counter())[((length, each),)] += n
    return [(n, content) for kinds in open_bins.values() for content, n in kinds.items() if n]


def dominated(filling: Filling, slack: int, counts: np.ndarray) -> bool:
    """Whether some items of the filling can give way to one longer item, or several to one as long, that is left over.

    Such an exchange leaves shorter items for the other bins, so a packing with this filling is no better than one without.
    """
    used = dict(filling)
    sums = {0: 0}  # sum -> most items that make it
    for length, uses in filling:
        for _ in range(uses):
            for total, items in list(sums.items()):
                sums[total + length] = max(sums.get(total + length, 0), items + 1)
        if len(sums) > 64:  # what the first sums do not settle is kept, not dropped
            break
    for total, items in sums.items():
        for other in range(max(total, 1) if items > 1 else total + 1, total + slack + 1) if items else ():
            if other < len(counts) and counts[other] > used.get(other, 0):
                return True
    return False


def exact_fillings(number: list[int], lengths: list[int], target: int, spent: list[int]) -> Iterator[list[int]]:
    """Items, longest first, that make `target`; number[i] items of length i are left, `lengths` are those, longest first.

    An item that makes what is left ends a filling: every split of it is dominated. Stops when spent[1] is used up.
    """
    if number[target]:
        yield [target]
        return
    shortest = lengths[-1]
    place = np.searchsorted(-np.array(lengths), -np.arange(target + 1)).tolist()  # of the longest item up to each length
    chosen, lefts, places = [], [target], [place[max(target - shortest, 0)]]
    while places:
        spent[0], spent[1] = spent[0] + 1, spent[1] - 1
        if spent[1] < 0:
            break
        at, left = places[-1], lefts[-1]
        while at < len(lengths) and not number[lengths[at]]:
            at += 1
        if at == len(lengths):
            places.pop(), lefts.pop()
            if chosen:
                number[chosen.pop()] += 1
            continue
        a = lengths[at]
        places[-1], rest = at + 1, left - a
        number[a] -= 1
        if rest > 0 and number[rest]:
            if rest <= a:
                yield [*chosen, a, rest]
            number[a] += 1
        elif rest < 2 * shortest:
            number[a] += 1
        else:
            chosen.append(a)
            lefts.append(rest)
            places.append(max(at, place[rest - shortest]))
    for a in chosen:
        number[a] += 1


def fillings(counts: np.ndarray, room: int, most_waste: int, spent: list[int]) -> Iterator[tuple[int, Filling]]:
    """(waste, filling) of the undominated ways to fill `room` with the items left, least waste first.

    Steps are added to spent[0]; after OF_NODE steps without a filling, the greedy one is given.
    """
    lengths = np.flatnonzero(counts[: room + 1])[::-1].tolist()
    if not lengths:
        if room <= most_waste:
            yield room, ()
        return
    number, given, here = counts[: room + 1].tolist(), False, [0, OF_NODE]
    for waste in range(min(most_waste, room - lengths[-1]) + 1):
        for items in exact_fillings(number, lengths, room - waste, here):
            spent[0], here[0] = spent[0] + here[0], 0
            filling = tuple(sorted(Counter(items).items(), reverse=True))
            if not dominated(filling, waste, counts):
                given = True
                yield waste, filling
        spent[0], here[0] = spent[0] + here[0], 0
        if here[1] < 0:
            break
    if not given:
        rest, left = [], room
        for a in lengths:
            uses = min(left // a, int(counts[a]))
            if uses:
                rest.append((a, uses))
                left -= a * uses
        if left <= most_waste:
            yield left, tuple(rest)


def complete_bins(counts: np.ndarray, steps: int = STEPS) -> list[tuple[int, Filling]]:
    """(how many bins, filling) that hold all items in as few bins as the search finds.

    Best-fit decreasing is the first incumbent. Each node takes the longest item left, tries the undominated fillings
    beside it, least waste first, and uses one for as many bins as the counts allow (then for fewer). A branch ends where
    its waste, or the bins that its rest cannot do without, leave no packing better than the incumbent; the search ends at
    a packing that meets the lower bound, when all branches are done, or after `steps` steps (a node is ten).
    """
    capacity = len(counts) - 1
    sizes = np.arange(capacity + 1)
    counts, total = counts.astype(np.int64), int((counts * sizes).sum())
    best = best_fit(counts)
    most, bound = sum(n for n, _ in best), least_bins(counts)
    if most <= bound:
        return best
    left, taken, used, wasted, spent = counts.copy(), [], 0, 0, [0]

    def branch() -> Iterator[tuple[int, int, Filling]]:
        longest = int(np.flatnonzero(left)[-1])
        left[longest] -= 1
        found = fillings(left.copy(), capacity - longest, (most - 1) * capacity - total - wasted, spent)
        left[longest] += 1
        for waste, rest in found:
            content = Counter(dict(rest))
            content[longest] += 1
            filling = tuple(sorted(content.items(), reverse=True))
            spare = (most - 1) * capacity - total - wasted
            times = min(int(left[a]) // n for a, n in filling)
            if waste:
                times = min(times, spare // waste)
            while times > 0:
                yield times, waste, filling
                times //= 2

    levels = [branch()]
    while spent[0] < steps:
        spent[0] += 10
        step = next(levels[-1], None) if levels else None
        while levels and step is None:
            levels.pop()
            if taken:
                times, waste, filling = taken.pop()
                used, wasted = used - times, wasted - times * waste
                for a, n in filling:
                    left[a] += times * n
            step = next(levels[-1], None) if levels else None
        if step is None:
            break
        times, waste, filling = step
        taken.append(step)
        used, wasted = used + times, wasted + times * waste
        for a, n in filling:
            left[a] -= times * n
        if not left.any():
            if used < most:
                best, most = [(t, f) for t, _, f in taken], used
                if most <= bound:
                    break
            levels.append(iter(()))
        elif used + least_bins(left) >= most:
            levels.append(iter(()))
        else:
            levels.append(branch())
    return best


@dataclass
class Places:
    """Where the pieces of each length go, by rank: sorted keys (length, first rank), first sequence, uses, offset."""

    keys: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    uses: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, bins: list[tuple[int, Filling]]) -> Places:
        rows, seen, sequence = [], Counter(), 0
        for times, filling in bins:
            offset = 0
            for length, uses in filling:
                rows.append((length, seen[length], sequence, uses, offset))
                seen[length] += times * uses
                offset += length * uses
            sequence += times
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        return cls((table[:, 0] << 48) + table[:, 1], *table[:, 1:].T)

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the piece of each length and rank."""
        at = np.searchsorted(self.keys, (lengths << 48) + ranks, side="right") - 1
        inside, uses = ranks - self.first[at], self.uses[at]
        return self.sequence[at] + inside // uses, self.offset[at] + inside % uses * lengths


def encoded(df: DataFrame, key: str, text: str, length: int, path: str, end: int) -> DataFrame:
    """key, part, n, width, ids, wholes, rest, and ranks in the partition of the first whole piece and of the rest: written once."""
    kind = df.schema[key].dataType.simpleString()

    def make():
        tool, part, seen, whole = piece_codec(path, end), TaskContext.get().partitionId(), Counter(), 0
        last = tool.packed([end])

        def work(columns):
            nonlocal whole
            texts = columns["text"].to_pylist()
            for a, b in portions(texts, CHUNK):
                ids = [x + last for x in tool.encode_all(texts[a:b])]
                sizes = np.array([len(x) for x in ids], np.int64) // tool.width
                wholes, rest = np.divmod(sizes, length)
                ranks = []
                for r in rest.tolist():
                    ranks.append(seen[r])
                    seen[r] += 1
                first = whole + np.cumsum(wholes) - wholes
                whole += int(wholes.sum())
                yield {
                    "key": columns["key"].slice(a, b - a), "part": [part] * (b - a), "n": sizes, "width": [tool.width] * (b - a), "ids": ids,
                    "wholes": wholes, "rest": rest.astype(np.int32), "whole_rank": first, "rest_rank": ranks,
                }

        return work

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind}, part int, n long, width int, ids binary, wholes long, rest int, whole_rank long, rest_rank long"
    return settle(map_columns(rows, make, schema), "encoded")


def first_ranks(totals: DataFrame, length: int) -> DataFrame:
    """part, rest, rest_base, whole_base: pieces of the same length in earlier partitions. `totals`: part, rest, rests, wholes."""
    whole = totals.groupBy("part").agg(F.sum("wholes").alias("pieces")).select("part", F.lit(length).alias("size"), "pieces")
    sizes = totals.where("rest > 0").select("part", F.col("rest").alias("size"), F.col("rests").alias("pieces")).unionByName(whole)
    earlier = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = settle(sizes.withColumn("base", F.coalesce(F.sum("pieces").over(earlier), F.lit(0))).drop("pieces"), "ranks")
    rests = base.where(F.col("size") < length).select("part", F.col("size").alias("rest"), F.col("base").alias("rest_base"))
    wholes = base.where(F.col("size") == length).select("part", F.col("base").alias("whole_base"))
    return settle(totals.select("part", "rest").join(rests, ["part", "rest"], "left").join(wholes, "part"), "bases")


def pack_best(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, path: str | None = None, end: int = END, steps: int = STEPS) -> DataFrame:
    """Pieces of documents in sequences of at most `length` tokens, as few sequences as the search finds.

    Returns key, piece (from 0), start (tokens of its document before it), length, ids (binary: little-endian unsigned
    32-bit), doc_tokens, sequence_id, offset. A document is its ids, then `end`; null text has `end` alone. Documents of
    over `length` tokens are cut into pieces of that length and a rest; others stay whole. Repeated rows and null keys are
    documents of their own, an empty table gives no piece, other columns are left out.

    Texts are encoded once and written with each piece's rank among its partition's pieces of its length; sums over
    partitions make that a rank in the whole. The driver sees one count per length. Tokens are shuffled only where the
    table of sums (a row per partition and length) is too large to be broadcast.
    """
    rows = encoded(df, key, text, length, path or vocabulary("word_bpe_49k.json"), end)
    totals = settle(rows.groupBy("part", "rest").agg(F.count("*").alias("rests"), F.sum("wholes").alias("wholes")), "totals")
    counts = np.zeros(length + 1, np.int64)
    for r in totals.groupBy("rest").agg(F.sum("rests").alias("rests"), F.sum("wholes").alias("wholes")).collect():
        counts[r["rest"]] += r["rests"] if r["rest"] else 0
        counts[length] += r["wholes"]
    shared = df.sparkSession.sparkContext.broadcast(Places.of(complete_bins(counts, steps)))
    kind = df.schema[key].dataType.simpleString()

    def make():
        def work(columns):
            value = {x: columns[x].to_numpy() for x in ("n", "wholes", "rest", "whole_rank", "rest_rank")}
            base = {x: columns[x].fill_null(0).to_numpy() for x in ("rest_base", "whole_base")}
            pieces = value["wholes"] + (value["rest"] > 0)
            row = np.repeat(np.arange(len(pieces)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            whole = piece < value["wholes"][row]
            size = np.where(whole, length, value["rest"][row]).astype(np.int64)
            rank = np.where(whole, (base["whole_base"] + value["whole_rank"])[row] + piece, (base["rest_base"] + value["rest_rank"])[row])
            sequence, offset = shared.value.find(size, rank)
            ids, width, size_of = columns["ids"], columns["width"].to_numpy(), 0
            begin = 0
            for i in range(len(row)):
                size_of += 4 * int(size[i])
                if size_of > 16 * CHUNK or i + 1 == len(row):
                    part = slice(begin, i + 1)
                    some = row[part]
                    known = {r: np.frombuffer(ids[r].as_py(), f"<u{width[r]}") for r in np.unique(some).tolist()}
                    yield {
                        "key": columns["key"].take(pa.array(some)), "piece": piece[part].astype(np.int32), "start": piece[part] * length, "length": size[part],
                        "ids": [known[r][p * length : p * length + s].astype("<u4").tobytes() for r, p, s in zip(some.tolist(), piece[part].tolist(), size[part].tolist())],
                        "doc_tokens": value["n"][some], "sequence_id": sequence[part], "offset": offset[part],
                    }
                    begin, size_of = i + 1, 0

        return work

    placed = rows.join(first_ranks(totals, length), ["part", "rest"])
    placed = placed.select("key", "n", "width", "ids", "wholes", "rest", "whole_rank", "rest_rank", "rest_base", "whole_base")
    schema = f"key {kind}, piece int, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return map_columns(placed, make, schema).withColumnRenamed("key", key)
