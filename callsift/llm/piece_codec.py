"""Ids of the tokenizers library at the cost of a look-up: texts are cut into pieces, and only new pieces go to its model."""

from __future__ import annotations

import gc
import json
import re
from collections.abc import Callable

import numpy as np
from tokenizers import Tokenizer

from callsift.llm.base import kept
from callsift.llm.bpe import LETTER, MEMORY, NUMBER, SPACE, Codec, byte_letters, character_classes

#: The pre-tokenisers that are cut here; files with another one are encoded by the library alone.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
WORDS = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        BYTE_LEVEL | {"use_regex": False},
    ],
}
LOWER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
#: Below this code point NFC changes nothing and a letter's lower case does not depend on its neighbours.
SIMPLE = re.compile("[^\x00-˿]")


class Memory:
    """Ids of pieces in one array; a piece is known by its place in it.

    Names are whole numbers (short pieces), kept as a sorted array, or strings.
    """

    def __init__(self, kind: type):
        self.places: dict[str, int] = {}
        self.numbers = np.zeros(0, np.uint64)
        self.places_of_numbers = np.zeros(0, np.int32)
        self.ids = np.zeros(1 << 16, kind)
        self.first = np.zeros(1 << 12, np.int64)  # of each place, and the first behind the last
        self.filled = 0

    def __len__(self) -> int:
        return len(self.places) + len(self.numbers)

    def find(self, names: np.ndarray | list[str]) -> np.ndarray:
        """The place of each name, -1 where it is not known."""
        if isinstance(names, list):
            return np.array([self.places.get(x, -1) for x in names], np.int64)
        if not len(self.numbers):
            return np.full(len(names), -1, np.int64)
        at = np.minimum(np.searchsorted(self.numbers, names), len(self.numbers) - 1)
        return np.where(self.numbers[at] == names, self.places_of_numbers[at], -1).astype(np.int64)

    def add(self, names: np.ndarray | list[str], new: list[int], sizes: list[int]) -> None:
        """Names that are not known yet, different and (numbers) in ascending order, with their ids in a row."""
        at, used = len(self), self.filled + len(new)
        while used > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while at + len(names) >= len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        self.ids[self.filled : used] = new
        self.first[at + 1 : at + 1 + len(names)] = self.filled + np.cumsum(sizes)
        self.filled = used
        if isinstance(names, list):
            self.places.update(zip(names, range(at, at + len(names))))
        else:
            where = np.searchsorted(self.numbers, names)
            self.numbers = np.insert(self.numbers, where, names)
            self.places_of_numbers = np.insert(self.places_of_numbers, where, np.arange(at, at + len(names), dtype=np.int32))

    def of(self, place: int) -> list[int]:
        return self.ids[self.first[place] : self.first[place + 1]].tolist()

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all places in a row, where each place's ids begin in it and the last ones end)."""
        sizes = self.first[places + 1] - self.first[places]
        edges = np.concatenate([[0], np.cumsum(sizes)])
        return self.ids[np.repeat(self.first[places] - edges[:-1], sizes) + np.arange(edges[-1])], edges


class PieceCodec(Codec):
    """Byte-level pieces, remembered with their ids; a new piece is asked of the library's model.

    A piece of at most eight characters of one byte is looked up as a number, so that only the different ones of a batch
    become Python values. Ids are packed little-endian in `width` bytes (2 where the vocabulary and the largest id beside
    it allow, else 4).
    """

    def __init__(self, path: str, beside: int = 0):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.width = 2 if max(beside, *self.library.get_vocab(with_added_tokens=True).values()) < 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}").type
        with open(path, encoding="utf-8") as file:
            added = json.load(file)["added_tokens"]
        self.special = {t["content"]: t["id"] for t in added}
        self.divider = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.letters = {b: ord(c) for c, b in byte_letters().items()}
        self.classes = character_classes()
        self.memory, self.older = Memory(self.kind), Memory(self.kind)

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def ids_of(self, piece: str) -> list[int]:
        name = piece.encode("utf-8").decode("latin-1").translate(self.letters)
        return [token.id for token in self.model.tokenize(name)]

    def places(self, names: np.ndarray | list[str], piece: Callable[[int], str]) -> np.ndarray:
        """The places of the named pieces; `piece` gives the string of the i-th, which is asked for only if it is new."""
        memory, older = self.memory, self.older
        found = memory.find(names)
        new = np.flatnonzero(found < 0)
        if len(new):
            ids, sizes, before = [], [], 0
            found[new] = np.arange(len(memory), len(memory) + len(new))
            unknown = [names[i] for i in new.tolist()] if isinstance(names, list) else names[new]
            for i, old in zip(new.tolist(), older.find(unknown).tolist()):
                ids += self.ids_of(piece(i)) if old < 0 else older.of(old)  # what is still in use comes back from the older half
                sizes.append(len(ids) - before)
                before = len(ids)
            memory.add(unknown, ids, sizes)
        return found

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        joined, at, before = self.cut(texts)
        if len(self.memory) > MEMORY:
            self.older, self.memory = self.memory, Memory(self.kind)
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.append(at[1:], len(code))
        size, wide = ends - at, np.concatenate([[0], np.cumsum((code > 255) | (code == 0))])
        short = (size <= 8) & (wide[ends] == wide[at])
        where, size = at[short], size[short]
        name = np.zeros(len(where), np.uint64)
        padded = np.concatenate([code.astype(np.uint8), np.zeros(8, np.uint8)])
        for i in range(8):
            name |= np.where(size > i, padded[where + i], 0).astype(np.uint64) << np.uint64(8 * i)
        names, first, which = np.unique(name, return_index=True, return_inverse=True)
        places = np.empty(len(at), np.int64)
        places[short] = self.places(names, lambda i: joined[where[first[i]] : where[first[i]] + size[first[i]]])[which]
        if len(where) < len(at):
            rest = [joined[a:b] for a, b in zip(at[~short].tolist(), ends[~short].tolist())]
            some = list(dict.fromkeys(rest))
            place = dict(zip(some, self.places(some, some.__getitem__).tolist()))
            places[~short] = [place[x] for x in rest]
        ids, edges = self.memory.gather(places)
        cuts = edges[before].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def whole(self, text: str) -> bytes:
        """Ids of a text that the library encodes as a whole."""
        return self.packed(self.library.encode(text, add_special_tokens=False).ids)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        plain = [t or "" for t in texts]
        special = {i for i, t in enumerate(plain) if self.divider and self.divider.search(t)}
        found = super().encode_all(["" if i in special else t for i, t in enumerate(plain)])
        for i in special:
            found[i] = self.whole(plain[i])
        return found


class WordCodec(PieceCodec):
    """Lower-case words, single digits and runs of other signs; white space is dropped."""

    def cut(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
        joined = " ".join(texts) + " "
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind = self.classes[code]
        borders = np.cumsum([0, *(len(t) + 1 for t in texts)])
        starts = np.ones(len(code) + 3, bool)
        np.not_equal(kind[1:], kind[:-1], out=starts[1 : len(code)])
        starts[: len(code)] |= kind == NUMBER
        change = starts.copy()
        for i in np.flatnonzero((code == 39) & change[: len(code)] & change[1 : len(code) + 1]).tolist():
            size = 2 if joined[i + 1 : i + 2] in tuple("stmd") else 3 if joined[i + 1 : i + 3] in ("re", "ve", "ll") else 0
            if size:
                starts[i + 1] = False
                if kind[i + size] == LETTER:
                    starts[i + size] = True
        at = np.flatnonzero(starts[: len(code)])
        return joined, at, np.searchsorted(at, borders)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        return super().encode_batch([t.lower() for t in texts])

    def ids_of(self, piece: str) -> list[int]:
        return [] if self.classes[ord(piece[0])] == SPACE else super().ids_of(piece)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        plain = [t or "" for t in texts]
        odd = {i for i, t in enumerate(plain) if not t.isascii() and SIMPLE.search(t)}
        found = super().encode_all(["" if i in odd else t for i, t in enumerate(plain)])
        for i in odd:
            found[i] = self.whole(plain[i])
        return found


class WholeCodec(PieceCodec):
    """Any other file: every text is encoded by the library."""

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        return [self.packed(e.ids) for e in self.library.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]


def kind_of(path: str) -> type[PieceCodec]:
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in data["added_tokens"]) or data["model"]["type"] != "BPE" or data["model"].get("dropout"):
        return WholeCodec
    if data["normalizer"] is None and data["pre_tokenizer"] == BYTE_LEVEL:
        return PieceCodec
    return WordCodec if (data["normalizer"], data["pre_tokenizer"]) == (LOWER, WORDS) else WholeCodec


def piece_codec(path: str, beside: int = 0) -> PieceCodec:
    """One codec for each file, worker process and stage; `beside` is the largest id that is written among its own."""

    def make() -> PieceCodec:
        made = kind_of(path)(path, beside)
        gc.freeze()  # the tables stay; the collector need not look through them again and again
        return made

    return kept((path, beside), make)
