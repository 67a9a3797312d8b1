"""Licence notices: a trained passage classifier whose predictions a comparison with notice templates confirms."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsift.llm.base import map_columns

#: Usual notices of each family.
NOTICES = {
    "AGPL": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the Apache License, Version 2.0.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0.",
        "SPDX-License-Identifier: Apache-2.0.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD License.",
    ],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related rights to this work.", "Released under CC0 1.0 Universal."],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU General Public License, version 2.",
        "Released under the GPL license.",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", "Released under the ISC License."],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
UNKNOWN = "unknown"
#: How each family is called, as normalised words; a version, "license" or "or later" may follow.
NAMES = {
    "AGPL": ["affero general public license", "gnu affero general public license", "agpl", "gnu agpl"],
    "Apache-2.0": ["apache 2", "apache license 2", "apache software license 2"],
    "BSD": ["bsd", "bsd style", *(f"{n} clause bsd" for n in ("2", "3", "4", "two", "three", "four")), *(f"bsd {n} clause" for n in ("2", "3", "4"))],
    "CC-BY": ["cc by", "creative commons attribution"],
    "CC-BY-NC": ["cc by nc", "creative commons attribution noncommercial", "creative commons attribution non commercial"],
    "CC-BY-SA": ["cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike"],
    "CC0": ["cc 0", "creative commons zero"],
    "GPL": ["general public license", "gnu general public license", "gpl", "gnu gpl"],
    "ISC": ["isc"],
    "LGPL": [*(f"{g}{x} general public license" for g in ("", "gnu ") for x in ("lesser", "library")), "lgpl", "gnu lgpl"],
    "MIT": ["mit", "mit x 11", "mit style", "expat"],
    "MPL-2.0": ["mozilla public license 2", "mpl 2"],
    "Unlicense": ["unlicense"],
}
#: Licences whose names begin like one of these families.
OTHERS = [
    *("cc by nd", "cc by nc nd", "cc by nc sa"),
    *(f"creative commons attribution {x}" for x in ("noderivatives", "no derivatives", "noderivs", "noncommercial noderivatives", "noncommercial sharealike")),
]
#: Templates in which a name grants something.
GRANTS = [
    *(
        f"{verb} under {terms}{{}}"
        for verb in ("licensed", "relicensed", "released", "distributed", "redistributed", "published", "available", "provided", "shared", "offered")
        for terms in ("", "terms of ", "conditions of ")
    ),
    *("redistribute it under {}", "under terms of {}", "covered by {}", "governed by {}", "subject to {}", "subject to terms of {}", "subject to conditions of {}"),
    *("in compliance with {}", "spdx license identifier {}", "license {}", "{} licensed", "see {} for details"),
]
#: A template for names that say "license"; others ("under MIT") need a verb.
FULL = "under {}"
#: Wordings of no grant, and of licences without a name, for the classifier to tell apart.
MENTIONS = [
    *("text of {} is hard to read", "many argued about {} last year", "we compared {} with other texts", "{} was discussed at meeting", "what is {}"),
    *("she taught under {} teachers and left", "{} engine flies over hills today", "books written at {} or elsewhere", "article about {}"),
    *("she works at {} in city", "questions about {} are not answered here", "people who like {} may read this", "{} has many words", "critics of {} say so"),
    *("conditions of {} are explained in chapter two", "terms of {} are often misread", "history of {} is long"),
]
DENIALS = ["not {}", "not yet {}", "no longer {}", "never {}", "neither {}", "nor {}", "cannot be {}", "not be {}"]
NAMELESS = [
    "permission is granted to anyone to use this software for any purpose",
    "permission is granted to copy and change this document",
    "this software is provided as is without any express or implied warranty",
    "all rights reserved under a proprietary license agreement",
    "use of this software is governed by the license agreement in file license",
    "you may copy and share this file under the license of its author",
]
ORDINARY = "bridge roof sky name lead eyes cover table water pressure direction guidance title sun rain law control way word house".split()
#: Words that stand around notices as around anything else.
COMMON = "this is are all you can use it in on our my code file files be may been project software work works library program for and with its see or later".split()
#: Passages of the corpus, about, that are learned as no licence; one of each drawn document.
SAMPLE = 2000
#: Words of a corpus passage, at most, that are put into examples; all of the passage is learned from.
SPARE = 20
#: Share of a template's word pairs that a passage must hold to confirm a family.
CONFIRM = 0.8
#: A calibrated probability under this is no prediction.
LEAST = 0.5
#: Words judged at once; a longer passage is judged in windows that overlap by half.
WINDOW = 60

_TOKEN = re.compile(r"[^\W\d_]+|\d+(?:\.\d+)*")
_END = re.compile(r"(?<=[.!?])(?<!\s[vV]\.)\s+|\n[ \t\r]*\n")
_SILENT = frozenset("the a an version v either both".split())
_SPELLED = {"licence": "license", "licenced": "licensed", "licences": "licenses", "gplv": "gpl", "lgplv": "lgpl", "agplv": "agpl", "mplv": "mpl"}
_JOIN = frozenset(("or", "and"))


def words(text: str) -> list[str]:
    """Words in one form: lower case, numbers apart from letters and without a final .0, no articles."""
    return normal(raw(text))


def normal(found: list[str]) -> list[str]:
    return [x[:-2] if x.endswith(".0") else _SPELLED.get(x, x) for x in found if x not in _SILENT]


def raw(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def passages(text: str | None) -> list[str]:
    """Sentences of the paragraphs of a whole text; a line break inside a paragraph is a space."""
    return [x for x in _END.split(text or "") if x]


def pairs_of(found: list[str]) -> frozenset:
    return frozenset(zip(found, found[1:]))


def grams(found: list[str]) -> set[str]:
    return {*found, *(f"{a} {b}" for a, b in zip(found, found[1:]))}


_CORES: dict[str, list[tuple[tuple[str, ...], str]]] = {}
for _family, _some in [*NAMES.items(), (UNKNOWN, OTHERS)]:
    for _name in _some:
        _CORES.setdefault(_name.split()[0], []).append((tuple(_name.split()), _family))
for _some in _CORES.values():
    _some.sort(key=lambda x: -len(x[0]))


def named(found: list[str]) -> list[tuple[int, int, str]]:
    """Where words name licences: start, end, family; the longest name at a place, with version, "license", "or later"."""
    out, at, n = [], 0, len(found)
    while at < n:
        core = next((x for x in _CORES.get(found[at], ()) if tuple(found[at : at + len(x[0])]) == x[0]), None)
        if core is None:
            at += 1
            continue
        end = at + len(core[0])
        while end < n:
            if found[end][0].isdigit() or found[end] in ("license", "only", "international", "universal", "style", "clause"):
                end += 1
            elif found[end] == "or" and found[end + 1 : end + 2] in (["later"], ["newer"]):
                end += 2
            else:
                break
        out.append((at, end, core[1]))
        at = end
    return out


def windows(found: list[str]) -> Iterator[list[str]]:
    """All words of a passage, WINDOW at a time; a name at a border is whole in both windows."""
    names = named(found) if len(found) > WINDOW else []
    for start in range(0, max(1, len(found) - WINDOW // 2), WINDOW // 2):
        end = start + WINDOW
        first = min([s for s, e, _ in names if s < start < e], default=start)
        yield found[first : max([e for s, e, _ in names if s < end < e], default=end)]


def single(found: list[str], names: list[tuple[int, int, str]]) -> Iterator[tuple[str, list[str], list[str]]]:
    """For each name its family, its words, and all words without the other names of its row ("A, B or C")."""
    rows: list[list[tuple[int, int, str]]] = []
    for name in names:
        if rows and _JOIN.issuperset(found[rows[-1][-1][1] : name[0]]):
            rows[-1].append(name)
        else:
            rows.append([name])
    for row in rows:
        for start, end, family in row:
            yield family, found[start:end], [*found[: row[0][0]], *found[start:end], *found[row[-1][1] :]]


def matches(found: list[str], notices: dict[str, list[list[str]]]) -> dict[str, float]:
    """The best share of word pairs of a template that the words hold, for every family of which there is any.

    Notices without a name stand for themselves. A name is compared with each grant that has it in the slot (pairs inside
    the name do not count), and with the family's notices that hold a name, without the other names of its row. A lone name that says "license" is a
    title if hardly any other word is there.
    """
    whole = pairs_of(found)
    best = {}
    for family, some in notices.items():
        for notice in some:
            pairs = pairs_of(notice)
            if pairs & whole and not named(notice):
                best[family] = max(best.get(family, 0.0), len(pairs & whole) / len(pairs))
    for family, name, alone in single(found, named(found)):
        if family in notices:
            full, there = "license" in name or "unlicense" in name, pairs_of(alone)
            inside = pairs_of(name)
            templates = [pairs_of(x.replace("{}", " ".join(name)).split()) - inside for x in [*GRANTS, *([FULL] if full else [])]]
            templates += [pairs_of(x) for x in notices[family] if named(x)]
            match = max(len(x & there) / len(x) for x in templates)
            best[family] = max(best.get(family, 0.0), 1.0 if full and len(alone) - len(name) <= 2 else match)
    return best


@dataclass
class Model:
    """families (the last is unknown), vocabulary (n-gram: row), weights and bias of one logistic regression for each family, given
    a notice, and, last, for a notice of any kind, temperature that calibrates them, notices as words."""

    families: list[str]
    vocabulary: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    notices: dict[str, list[list[str]]] = field(default_factory=dict)

    def __post_init__(self):
        self.blank = self.probabilities([])
        self.floor = self.temperature * math.log(LEAST / (1 - LEAST))
        self.scores = {g: float(self.weights[row, -1]) for g, row in self.vocabulary.items()}
        #: What a word can add to the score of a notice at most: its weight, and those of n-grams that it brings. Each
        #: n-gram is booked on that of its words which is in fewer of them.
        uses = Counter(w for g in self.vocabulary for w in g.split(" "))
        gain: Counter = Counter()
        for gram, row in self.vocabulary.items():
            gain[min(gram.split(" "), key=lambda w: (uses[w], w))] += max(0.0, float(self.weights[row, -1]))
        spelled = {**{w: w for w in gain}, **{f"{w}.0": w for w in gain if w[0].isdigit()}, **{k: v for k, v in _SPELLED.items() if v in gain}}
        self.gain = {k: gain[v] for k, v in spelled.items() if gain[v] > 0}
        self.gainful = frozenset(self.gain)

    def notice(self, found: list[str]) -> float:
        """The score of a notice; below the floor nothing is predicted."""
        return sum((self.scores[g] for g in grams(found) if g in self.scores), float(self.bias[-1]))

    def hopeless(self, found: list[str]) -> bool:
        """No window of these words (as they are written) can reach the score of a notice."""
        return self.bias[-1] + sum(self.gain[w] for w in self.gainful.intersection(found)) < self.floor

    def probabilities(self, rows: list[int]) -> np.ndarray:
        z = (self.weights[rows].sum(axis=0) + self.bias) / self.temperature
        p = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        p[:-1] *= p[-1]
        return p

    def guess(self, found: list[str]) -> np.ndarray:
        rows = sorted(self.vocabulary[g] for g in grams(found) if g in self.vocabulary)
        return self.probabilities(rows) if rows else self.blank

    def judged(self, found: list[str]) -> list[tuple[str, float, float]]:
        """Every predicted family of a passage's words with its probability and match, in the order of families.

        Each family is decided by the regressions, on the passage and, of names in a row, on it with one of them; templates only confirm. A window that is a notice of none of them
        is unknown, with match 0. Of several windows the best match counts, then the best probability.
        """
        best: dict[str, tuple[float, float]] = {}
        for part in windows(found):
            if self.hopeless(part):
                continue
            names = named(part)
            row = [alone for _, _, alone in single(part, names) if len(alone) < len(part)]
            if not row and self.notice(part) < self.floor:
                continue
            p = np.max([self.guess(x) for x in [part, *row]], axis=0)
            sure = [i for i in range(len(p) - 1) if p[i] >= LEAST]
            match = matches(part, self.notices) if sure else {}
            for i in sure:
                got = (match.get(self.families[i], 0.0), float(p[i]))
                best[self.families[i]] = max(best.get(self.families[i], got), got)
            if not sure and p[-1] >= LEAST:
                best[UNKNOWN] = max(best.get(UNKNOWN, (0.0, 0.0)), (0.0, float(p[-1])))
        if len(best) > 1:
            best.pop(UNKNOWN, None)
        return [(f, best[f][1], best[f][0]) for f in self.families if f in best]

    def families_of(self, passage: str) -> list[tuple[str, float, float]]:
        found = raw(passage)
        return [] if self.hopeless(found) else self.judged(normal(found))

    def judge(self, passage: str) -> tuple[str, float, float]:
        """The passage's best family, its probability and its match; unknown with the chance of no family if there is none."""
        found = self.families_of(passage)
        if found:
            return max(found, key=lambda x: (x[2] >= CONFIRM, x[1]))
        return UNKNOWN, 1 - float(max(self.guess(x)[:-1].max() for x in windows(words(passage)))), 0.0


def _told(y: np.ndarray) -> np.ndarray:
    """Weights of the examples: of a notice for the families, those that it belongs to thrice, of every row for the last column."""
    told = y[:, -1:] * (1 + 2 * y)
    told[:, -1] = 1
    return told


def _descend(x: np.ndarray, y: np.ndarray, steps: int = 700) -> tuple[np.ndarray, np.ndarray]:
    """One logistic regression per column of y with an L1 penalty (most n-grams lose their weight), by Adam on the bounded training set.

    The last column says which rows are notices; the others are learned from these alone.
    """
    told = _told(y)
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.full(y.shape[1], -3.0, np.float32)
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    for step in range(1, steps + 1):
        error = (1 / (1 + np.exp(-np.clip(x @ w + b, -60, 60))) - y) * told / len(y)
        rate = 0.2 * (1 - 0.95 * step / steps)
        for i, (value, slope) in enumerate(((w, x.T @ error), (b, error.sum(axis=0)))):
            m, v = state[2 * i], state[2 * i + 1]
            m += 0.1 * (slope - m)
            v += 0.01 * (slope * slope - v)
            value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-5)
        shrink = rate * 0.002
        w = np.sign(w) * np.maximum(np.abs(w) - shrink, 0)
    return w, b


def _called(family: str, some: list[str], draw: random.Random) -> str:
    name = draw.choice(some)
    if not name.endswith(("license", "unlicense")) and not name[-1].isdigit():
        name += draw.choice(("", " license", " 4 license" if name.startswith(("cc", "creative")) else " license"))
    elif not name.endswith("unlicense"):
        name += draw.choice(("", "", " 3" if name.endswith("license") else " license"))
    return name + draw.choice(("", "", "", " or later", " only"))


def _examples(notices: dict[str, list[str]], spare: list[str], variants: int, draw: random.Random) -> list[tuple[list[str], set[str]]]:
    """Words and labels (families; unknown for a notice of any kind) of made-up passages from templates, names and spare words."""
    known = {k: NAMES.get(k, []) for k in notices}
    spdx = [x for x in GRANTS if "identifier" in x]
    grants = [*GRANTS, FULL, *GRANTS, *spdx * 8, *["covered by {}", "see {} for details"] * 3, *["{} licensed"] * 12]

    # words of mentions stand around grants too, so that none of them alone speaks against a notice
    ordinary = [*COMMON, *(w for x in MENTIONS for w in x.replace("{}", "").split())]

    def around(found: list[str]) -> list[str]:
        filler = draw.choice((spare, ordinary))
        return draw.choices(filler, k=draw.randint(0, 8)) + found + draw.choices(filler, k=draw.randint(0, 8))

    def invented() -> str:
        lead = draw.choices([*spare, "public", "software", "open", "free"], k=draw.randint(1, 3))
        return " ".join(lead) + draw.choice((" license", " license", " public license", " license 2"))

    out: list[tuple[list[str], set[str]]] = []
    for family, some in notices.items():
        for notice in some:
            out += [(around(words(notice)), {family, UNKNOWN}) for _ in range(variants)]
            for _ in range(variants // 2):
                found = words(notice)
                at, size = draw.randrange(len(found)), draw.randint(1, max(1, len(found) // 4))
                out.append((around(found[at : at + size]), set()))
        for _ in range(variants * 8 if known[family] else 0):
            out.append((around(draw.choice(grants).replace("{}", _called(family, known[family], draw)).split()), {family, UNKNOWN}))
        for _ in range(variants * 4 if known[family] else 0):
            name = _called(family, known[family], draw)
            out.append((around(draw.choice(MENTIONS).replace("{}", name).split()), set()))
            out.append((around(name.split() if "license" not in name else [*name.split(), "was", "read"]), set()))
            denied = draw.choice(DENIALS).replace("{}", draw.choice(grants).replace("{}", name)).split()
            out.append((around(denied), set()))
            full = name if "license" in name else f"{name} license"
            out.append((full.split(), {family, UNKNOWN}))
            for _ in range(3):
                other = draw.choice([k for k in known if known[k]])
                first, second = draw.sample([name, _called(other, known[other], draw)], k=2)
                joined = draw.choice((f"{first} or {second}", f"{first} and {second}", f"{first} {second}", f"{first} its parts under {second}"))
                out.append((around(draw.choice(grants).replace("{}", joined).split()), {family, other, UNKNOWN}))
    for _ in range(variants * 20):
        name = draw.choice((invented(), invented(), _called(UNKNOWN, OTHERS, draw)))
        out.append((around(draw.choice(grants).replace("{}", name).split()), {UNKNOWN}))
        out.append((around(["licensed", "under", draw.choice(spare)]), {UNKNOWN}))
        out.append((around(["spdx", "license", "identifier", draw.choice(spare)]), {UNKNOWN}))
        out.append((around(words(draw.choice(NAMELESS))), {UNKNOWN}))
        out.append((around([draw.choice(("released", "distributed", "published", "available", "studied", "covered")), draw.choice(("under", "by", "in")), draw.choice(ORDINARY)]), set()))
        out.append((around([draw.choice(("driving", "fishing", "hunting", "radio", "poetic")), draw.choice(("license", "licenses"))]), set()))
        out.append((around(draw.sample([*ORDINARY, "public", "terms", "of", "free", "general", "file", "use", "not", "software", "domain"], k=6)), set()))
    return out


def _fixed_grams(notices: dict[str, list[str]]) -> set[str]:
    """The n-grams that can have a weight: those of notices, templates with names, mentions and denials."""
    found: set[str] = set()
    for text in [*(n for some in notices.values() for n in some), *NAMELESS]:
        found |= grams(words(text))
    names = [n + end for some in [*NAMES.values(), OTHERS] for n in some for end in ("", " license", " only", " or later", " 3", " 4")]
    for frame in [*GRANTS, FULL, *MENTIONS, *DENIALS]:
        before, after = frame.split("{}")
        found |= grams(before.split()) | grams(after.split())
        if frame in GRANTS or frame == FULL:
            for denial in DENIALS:
                found |= grams(denial.replace("{}", before).split())
    for name in names:
        found |= grams(name.split())
        for link in ("under", "of", "by", "to", "with", "identifier", "license", "or", "and", "see"):
            found.add(f"{link} {name.split()[0]}")
        found |= {f"{name.split()[-1]} {link}" for link in ("licensed", "or", "and")}
    return found | set(COMMON) | {"driving", "fishing", "hunting", "radio", "poetic", "driving license", *ORDINARY}


def _reduced(found: list[str], known: set[str], notices: dict[str, list[list[str]]]) -> tuple[list[list[str]], list[str]] | None:
    """A corpus passage as the known n-grams of its windows and some words; null if it may be a notice."""
    if named(found) or not {"license", "licensed", "licenses", "spdx"}.isdisjoint(found):
        return None
    parts = [grams(x) & known for x in windows(found)]
    if any(m >= CONFIRM for x in windows(found) for m in matches(x, notices).values()):
        return None
    return sorted({tuple(sorted(x)) for x in parts}), sorted(set(found) - known)[:SPARE]


def _learn(negatives: list[tuple[list[list[str]], list[str]]], notices: dict[str, list[str]], variants: int) -> Model:
    draw = random.Random(5)
    families = [*sorted(notices), UNKNOWN]
    spare = sorted({w for _, some in negatives for w in some}) or ["other", "thing"]
    made = [(grams(found), labels) for found, labels in _examples(notices, spare, variants, draw)]
    made += [(set(part), set()) for parts, _ in negatives for part in parts] + [(set(), set())] * 20
    draw.shuffle(made)
    vocabulary = {g: i for i, g in enumerate(sorted(_fixed_grams(notices)))}
    x, y = np.zeros((len(made), len(vocabulary)), np.float32), np.zeros((len(made), len(families)), np.float32)
    for i, (found, labels) in enumerate(made):
        x[i, [vocabulary[g] for g in found if g in vocabulary]] = 1
        y[i, [families.index(k) for k in labels]] = 1
    held = len(made) // 5
    w, b = _descend(x[held:], y[held:])
    z, target = x[:held] @ w + b, y[:held]

    def loss(t: float) -> float:
        return float(((np.logaddexp(0, z / t) - target * z / t) * _told(target)).mean())

    kept = np.flatnonzero(np.abs(w).max(axis=1) > 0)
    names = sorted(vocabulary)
    small = {names[i]: at for at, i in enumerate(kept)}
    temperature = min((0.25 * 1.1**i for i in range(40)), key=loss)
    return Model(families, small, w[kept].astype(float), b.astype(float), temperature, {k: [words(n) for n in notices[k]] for k in notices})


def fit(negatives: list[str], notices: dict[str, list[str]] = NOTICES, variants: int = 12) -> Model:
    """Learn from notices and templates with names, and from denials, mentions, fragments and corpus passages as no notice.

    Licences with invented names are notices of no family. Passages of the corpus that a template fits, or that name or
    mention a licence, are left out, since nobody knows their label. The temperature is the one that fits the
    probabilities of a held-out fifth best.
    """
    known, plain = _fixed_grams(notices), {k: [words(n) for n in notices[k]] for k in notices}
    return _learn([x for x in (_reduced(words(p), known, plain) for p in negatives) if x], notices, variants)


def train(df: DataFrame, text: str = "text", sample: int = SAMPLE, notices: dict[str, list[str]] = NOTICES) -> Model:
    """Fit with one whole passage of each of about `sample` documents, drawn by a hash of the text.

    Tasks reduce a passage to the n-grams that can have a weight, window by window (equal windows once), and SPARE other
    words. Null and empty texts and empty tables give no passage; copies of a text are drawn once.
    """
    rows = df.select(F.col(text).alias("text")).where("text IS NOT NULL")
    n = rows.count()

    def make():
        known, plain = _fixed_grams(notices), {k: [words(n) for n in notices[k]] for k in notices}

        def work(columns):
            found = ((p, len(t)) for t, p in ((t, passages(t)) for t in columns["text"].to_pylist()) if p)
            kept = [x for x in (_reduced(words(p[size % len(p)]), known, plain) for p, size in found) if x]
            return {"parts": [x for x, _ in kept], "spare": [x for _, x in kept]}

        return work

    drawn = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.lit(min(1.0, sample / max(1, n))) * (1 << 30)).distinct()
    parts = map_columns(drawn, make, "parts array<array<string>>, spare array<string>").collect()
    return _learn(sorted((r["parts"], r["spare"]) for r in parts), notices, 12)


def scan(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds (or replaces) licenses: array of (family, probability, match, passage) in the order of the text.

    Every passage of a whole text is judged; each family predicted for it is listed, confirmed ones have match >= CONFIRM.
    A notice of no known family is listed as unknown, with match 0. Passages whose words cannot add up to a notice, even
    if every pair of words were there, are passed over; that changes no result. Null and empty texts have an empty list,
    repeated rows stay, an empty table gives an empty table. Narrow; the model is broadcast (its size depends on the
    notices alone).
    """
    kind = T._parse_datatype_string("licenses array<struct<family:string,probability:double,match:double,passage:string>>")
    rest = [f for f in df.schema.fields if f.name != "licenses"]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def one(value):
            found = []
            for passage in passages(value):
                for family, p, match in model.families_of(passage):
                    found.append({"family": family, "probability": p, "match": match, "passage": passage})
            return found

        return lambda columns: {f.name: columns[f.name] for f in rest} | {"licenses": [one(x) for x in columns[text].to_pylist()]}

    return map_columns(df.select(*[F.col(f"`{f.name}`") for f in rest]), make, T.StructType(rest + kind.fields))
