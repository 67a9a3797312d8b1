"""Byte-level BPE by dynamic programming over prefixes: exact ids without replaying merges."""

from __future__ import annotations

import gc
import json
import re
from array import array

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from callsift.llm.base import map_columns, portions

#: Characters whose pieces are found at once, and entries that a worker's memories may hold before they start anew.
CHUNK = 1_000_000
MEMORY = 600_000

OTHER, LETTER, NUMBER, SPACE = range(4)


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files of this kind."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def character_classes() -> np.ndarray:
    """The class of every code point, as the library's own patterns see it (its Unicode version may be newer than Python's)."""
    codes = np.delete(np.arange(0x40000, dtype=np.uint32), np.s_[0xD800:0xE000])  # there is none of these classes in later planes
    every = codes.tobytes().decode("utf-32-le")
    found = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        matcher = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        for _, (start, stop) in matcher.pre_tokenize_str(every):
            found[codes[start:stop]] = kind
    return found


class Codec:
    """Encoder and decoder of a byte-level BPE file of the tokenizers library (merge order, usual pre-tokenisation)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, cutter = data["model"], data["pre_tokenizer"] or {}
        usual = model["type"] == "BPE" and cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter["add_prefix_space"]
        odd = data["normalizer"] or model.get("dropout") or model.get("ignore_merges") or model.get("byte_fallback") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")
        if not usual or odd or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in data["added_tokens"]):
            raise ValueError(f"{path} is not a plain byte-level BPE")
        letters = byte_letters()
        back = {b: c for c, b in letters.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        names = [back[b] for b in range(256)] + [a + b for a, b in pairs]
        rank = {name: i for i, name in enumerate(names)}
        # ranks: bytes first, then merges in their order; `halves` of a byte are itself
        self.left = [*range(256), *(rank[a] for a, _ in pairs)]
        self.right = [*range(256), *(rank[b] for _, b in pairs)]
        self.joined = {(rank[a], rank[b]): rank[a + b] for a, b in pairs}
        self.ids = [model["vocab"][name] for name in names]
        self.known_pairs: dict[int, bool] = {}
        # a token that its own merges never make is no candidate
        usable = [i for i in range(len(names)) if i < 256 or self.compatible(self.left[i], self.right[i], i)]
        self.build_automaton([(bytes(letters[c] for c in names[i]), i) for i in usable])
        self.tokens = {model["vocab"][name]: bytes(letters[c] for c in name) for name in model["vocab"] for _ in [0] if all(c in letters for c in name)}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens |= {i: content.encode() for content, i in self.special.items()}
        self.divider = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.classes = character_classes()
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def compatible(self, a: int, b: int, limit: int = 1 << 60) -> bool:
        """Whether b may follow a: no merge across their border comes before the merges that made them.

        Undoes the later of both tokens' merges step by step and looks each time for an earlier merge across the border.
        """
        left, right, joined = self.left, self.right, self.joined
        while True:
            across = joined.get((a, b))
            if across is not None and across < limit:
                return False
            if a > b:
                limit, half = a, right[a]
                if half != a:
                    a = half
                    continue
                undo_a = False
            else:
                undo_a = left[b] == b
            if undo_a:
                limit, half = a, right[a]
                if half == a:
                    return True
                a = half
            else:
                limit, half = b + 1, left[b]
                if half == b:
                    return True
                b = half

    def build_automaton(self, tokens: list[tuple[bytes, int]]) -> None:
        """States are the beginnings of tokens. found[state]: (token, length) of all tokens that end there, longest first."""
        self.step, own, depth = {}, [None], [0]
        for data, token in tokens:
            state = 0
            for byte in data:
                key = state << 8 | byte
                if key not in self.step:
                    self.step[key] = len(own)
                    own.append(None)
                    depth.append(depth[state] + 1)
                state = self.step[key]
            own[state] = token
        self.back, self.found = [0] * len(own), [()] * len(own)
        for key, state in sorted(self.step.items(), key=lambda x: depth[x[1]]):
            above, byte = key >> 8, key & 255
            if above:
                at = self.back[above]
                while at and at << 8 | byte not in self.step:
                    at = self.back[at]
                self.back[state] = self.step.get(at << 8 | byte, 0)
            shorter = self.found[self.back[state]]
            self.found[state] = shorter if own[state] is None else ((own[state], depth[state]), *shorter)

    def follow(self, state: int, byte: int) -> int:
        """The longest beginning of a token that ends here, remembered as a step of its own."""
        at = state
        while at and at << 8 | byte not in self.step:
            at = self.back[at]
        self.step[state << 8 | byte] = found = self.step.get(at << 8 | byte, 0)
        return found

    def learn(self, pieces: set[str]) -> None:
        """Ids of new pieces: for every prefix the one last token that fits, then back from the end.

        What holds for a prefix holds in every piece that begins with it, so pieces are taken in order and keep what they
        share with the piece before.
        """
        step, found, known, ids = self.step, self.found, self.known_pairs, self.ids
        states, last, size, before = [0], [-1], [0], b""
        for data, piece in sorted((p.encode("utf-8"), p) for p in pieces):
            same, most = 0, min(len(before), len(data))
            while same < most and before[same] == data[same]:
                same += 1
            del states[same + 1 :], last[same + 1 :], size[same + 1 :]
            state = states[-1]
            for end in range(same, len(data)):
                state = step[key] if (key := state << 8 | data[end]) in step else self.follow(state, data[end])
                for token, n in found[state]:
                    at = end + 1 - n
                    if not at:
                        break
                    pair = last[at] << 20 | token
                    fits = known.get(pair)
                    if fits is None:
                        fits = known[pair] = self.compatible(last[at], token)
                    if fits:
                        break
                states.append(state)
                last.append(token)
                size.append(n)
            emitted, at = [], len(data)
            while at:
                emitted.append(ids[last[at]])
                at -= size[at]
            emitted.reverse()
            self.pieces[piece] = array("I", emitted).tobytes()
            before = data

    def cut(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
        """The joined texts, where pieces start in them, and the number of pieces before each text.

        Pieces: English contractions, runs of letters, numbers or other signs, each with a space before it, and white
        space, of which the last one before a run stands alone or belongs to the run.
        """
        joined = "".join(texts)
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind, n = self.classes[code], len(code)
        borders = np.cumsum([0, *map(len, texts)])
        first = np.zeros(n + 4, bool)
        first[borders] = True
        first[n:] = True
        change = np.ones(n + 4, bool)
        np.not_equal(kind[1:], kind[:-1], out=change[1:n])
        change |= first
        starts = change[:n].copy()
        after = np.flatnonzero(starts[1:] & (kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~first[1:n]) + 1
        starts[after - 1] = True
        starts[after[code[after - 1] == 32]] = False
        quotes = np.flatnonzero((code == 39) & starts & change[1 : n + 1] & ~first[1 : n + 1])
        for i in quotes.tolist():
            size = 0
            if joined[i + 1] in "stmd":
                size = 2
            elif not first[i + 2] and joined[i + 1 : i + 3] in ("re", "ve", "ll"):
                size = 3
            if size:
                starts[i + 1] = False
                if i + size < n:
                    starts[i + size] = True
        at = np.flatnonzero(starts)
        return joined, at, np.searchsorted(at, borders)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        joined, at, before = self.cut(texts)
        ends = [*at[1:].tolist(), len(joined)]
        pieces = [joined[a:b] for a, b in zip(at.tolist(), ends)]
        if len(self.pieces) > MEMORY:  # what is still in use comes back from the older half
            self.older, self.pieces = self.pieces, {}
        if len(self.known_pairs) > 2 * MEMORY:
            self.known_pairs.clear()
        known, older = self.pieces, self.older
        new = set(pieces).difference(known)
        if older:
            back = new & older.keys()
            known.update((x, older[x]) for x in back)
            new -= back
        self.learn(new)
        found = [known[x] for x in pieces]
        return [b"".join(found[a:b]) for a, b in zip(before.tolist(), before[1:].tolist())]

    def encode(self, text: str) -> bytes:
        """Ids of one text of any length; special tokens in it get their ids."""
        found = []
        for part in self.divider.split(text) if self.divider else [text]:
            if part in self.special:
                found.append(np.array([self.special[part]], "<u4").tobytes())
                continue
            while len(part) > CHUNK:  # a single space between two other characters starts a piece, whatever follows
                border = re.compile(r"\S \S").search(part, CHUNK)
                if not border:
                    break
                found += self.encode_batch([part[: border.start() + 1]])
                part = part[border.start() + 1 :]
            found += self.encode_batch([part])
        return b"".join(found)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; null is empty."""
        plain = [t or "" for t in texts]
        alone = {i for i, t in enumerate(plain) if len(t) > CHUNK or self.divider and self.divider.search(t)}
        found = self.encode_batch(["" if i in alone else t for i, t in enumerate(plain)])
        for i in alone:
            found[i] = self.encode(plain[i])
        return found

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 become replacement characters."""
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec for each file and worker process."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
        gc.freeze()  # the tables stay; the collector need not look through them again and again
    return _CODECS[path]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    return public_tokenizers.path(name)


def encode_decode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """key, ids (binary: little-endian unsigned 32-bit), decoded (text of those ids) for each row; null text is empty.

    Narrow: no shuffle. Texts are taken in portions of CHUNK characters, so a batch of long texts needs no more memory
    than one of them. Repeated rows give repeated rows.
    """
    path = path or vocabulary()
    kind = df.schema[key].dataType.simpleString()

    def make():
        tool = codec(path)

        def work(columns):
            texts = columns["text"].to_pylist()
            for a, b in portions(texts, CHUNK):
                ids = tool.encode_all(texts[a:b])
                yield {"key": columns["key"].slice(a, b - a), "ids": ids, "decoded": [tool.decode(x) for x in ids]}

        return work

    made = map_columns(df.select(F.col(key).alias("key"), F.col(text).alias("text")), make, f"key {kind}, ids binary, decoded string")
    return made.withColumnRenamed("key", key)
