"""Licence scan: every planted notice of the documents, no other document, and held-out variants."""

import math
import re

import pyarrow.parquet as pq

from callsift.llm import licenses as L
from callsift.llm.queries import QUERIES

PLANTED = {
    "This work is licensed under the GNU General Public License, version 3.": "GPL",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
}


def test_query_finds_what_the_documents_hold(spark):
    folder = "/root/testdata/sf0.1"
    texts = pq.read_table(f"{folder}/documents.parquet").to_pandas().set_index("doc_id")["text"]
    got = {r["doc_id"]: r["families"] for r in QUERIES["op9_licenses"](spark, folder).collect()}
    assert set(got) == set(texts.index)
    for name, text in texts.items():
        wanted = ",".join(sorted({f for notice, f in PLANTED.items() if notice in text}))
        assert got[name] == wanted, (name, got[name], wanted)
    assert any(got.values())


def test_variants_and_plain_text():
    model = L.fit(["the weather was fine and the garden was green today", "er reat ond the inly thon"])
    family = lambda text: (lambda f, p, m: f if m >= L.CONFIRM else L.UNKNOWN)(*model.judge(text))
    assert family("This project is released under the MIT License.") == "MIT"
    assert family("Licensed under the Apache License, Version 2.0 (the License).") == "Apache-2.0"
    assert family("This library is licensed under the GNU Lesser General Public License, version 3.") == "LGPL"
    assert family("Licensed under CC BY-SA 4.0") == "CC-BY-SA"
    for text in ("", "She got a driving license in the public domain of the city.", "the terms of the general public", "He was released under the bridge."):
        assert family(text) == L.UNKNOWN


def test_odd_rows(spark):
    model = L.fit(["some words of a plain text"])
    rows = [(1, None, "x"), (1, None, "x"), (2, "", "y"), (None, "a. " * 5000 + "Released under the MIT License.", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, licenses string")
    got = sorted((r["doc_id"] or 0, [x["family"] for x in r["licenses"]]) for r in L.scan(df, model).collect())
    assert got == [(0, ["MIT"]), (1, []), (1, []), (2, [])]
    assert L.scan(df.limit(0), model).count() == 0
    assert L.train(df.limit(0)).families[-1] == L.UNKNOWN


def test_usual_wordings_and_identifiers():
    model = L.fit(["the weather was fine and the garden was green today", "er reat ond the inly thon"])
    found = lambda text: sorted({f for x in L.passages(text) for f, _, m in model.families_of(x) if m >= L.CONFIRM})
    for text, wanted in {
        "Distributed under the MIT License": ["MIT"],
        "Licensed under the Apache License 2.0": ["Apache-2.0"],
        "This package is made available under the 3-clause BSD license, see LICENSE.": ["BSD"],
        "The code in this folder is covered by GPLv3 or later.": ["GPL"],
        "You can use it subject to the Mozilla Public License v2.0": ["MPL-2.0"],
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": ["MPL-2.0"],
        "All pictures are shared under CC-BY-SA 3.0.": ["CC-BY-SA"],
        "MIT License": ["MIT"],
        "Licensed under the MIT License or the Apache License, Version 2.0": ["Apache-2.0", "MIT"],
        "SPDX-License-Identifier: MIT OR Apache-2.0": ["Apache-2.0", "MIT"],
        "Dual-licensed under Apache 2.0 and MIT.": ["Apache-2.0", "MIT"],
        "The library is distributed under the LGPL, its tools under the GNU General Public License.": ["GPL", "LGPL"],
        "MIT and Apache-2.0 licensed": ["Apache-2.0", "MIT"],
        "Papers published by Harvard or MIT are listed.": [],
        "Er wurde published mit der Bahn.": [],
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.": [],
    }.items():
        assert found(text) == wanted, (text, [model.families_of(x) for x in L.passages(text)])
    for name, family in {
        "MIT": "MIT", "GPL-3.0": "GPL", "GPL-2.0-or-later": "GPL", "LGPL-2.1-only": "LGPL", "AGPL-3.0-only": "AGPL", "BSD-3-Clause": "BSD",
        "Apache-2.0": "Apache-2.0", "ISC": "ISC", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0", "CC-BY-4.0": "CC-BY", "CC-BY-NC-4.0": "CC-BY-NC",
        "CC-BY-SA-4.0": "CC-BY-SA", "Unlicense": "Unlicense",
    }.items():
        assert found(f"SPDX-License-Identifier: {name}") == [family], (name, model.families_of(f"SPDX-License-Identifier: {name}"))


def test_mentions_denials_and_licences_of_no_family():
    model = L.fit(["the weather was fine and the garden was green today", "er reat ond the inly thon"])
    found = lambda text: [(f, m >= L.CONFIRM) for x in L.passages(text) for f, _, m in model.families_of(x)]
    for text in (
        "This software is not licensed under the GPL",
        "The terms of the GPL were debated for years",
        "He has studied under MIT professors and was released",
        "The Apache 2 helicopter is available in version 2 today",
        "The files are no longer distributed under the Mozilla Public License 2.0.",
    ):
        assert not any(sure for _, sure in found(text)), text
    for text in (
        "Licensed under the EUPL, Version 1.2 or later",
        "Distributed under the Boost Software License, Version 1.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it freely.",
        "SPDX-License-Identifier: Zlib",
    ):
        assert found(text) == [(L.UNKNOWN, False)], text


#: Wordings that no template of the operator holds, with the families they grant.
FRAMES = ["Feel free to use this, it is {} licensed.", "All of our code is available under the {} since last spring.", "The whole repository was relicensed under {} in March.",
          "Everything here may be redistributed under the terms of {}.", "Parts of these pages are governed by {}, as agreed."]
KNOWN = {"MIT": "the MIT License", "GPL": "the GNU GPL", "LGPL": "LGPLv2.1", "AGPL": "AGPL-3.0", "Apache-2.0": "Apache 2.0", "BSD": "the 2-clause BSD licence",
         "CC-BY": "CC BY 3.0", "CC-BY-SA": "Creative Commons Attribution-ShareAlike 3.0", "CC-BY-NC": "CC-BY-NC", "MPL-2.0": "the Mozilla Public License 2.0",
         "ISC": "the ISC licence", "CC0": "CC0"}
CLEAN = ["Nobody likes {} as much as its author.", "The lecture on {} begins at noon.", "{} is mentioned twice in chapter three.", "We never released anything under {}.",
         "A short introduction to {} and its critics."]


def test_held_out_precision_and_recall():
    model = L.fit(["the weather was fine and the garden was green today", "er reat ond the inly thon"])
    right = wrong = missed = 0
    for family, name in KNOWN.items():
        for frame in [*FRAMES, *CLEAN]:
            got = {f for f, _, m in model.families_of(frame.format(name)) if m >= L.CONFIRM}
            wanted = {family} if frame in FRAMES else set()
            right, wrong, missed = right + len(got & wanted), wrong + len(got - wanted), missed + len(wanted - got)
    print(f"precision {right / (right + wrong):.3f}, recall {right / (right + missed):.3f}")
    assert right / (right + wrong) >= 0.95 and right / (right + missed) >= 0.75


def plain_predictions(model, passage):
    """The model's prediction written plainly: every window, every n-gram, no shortcut."""
    tokens = [t for t in re.findall(r"[^\W\d_]+|\d+(?:\.\d+)*", passage.lower()) if t not in {"the", "a", "an", "version", "v", "either", "both"}]
    spelled = {"licence": "license", "licenced": "licensed", "licences": "licenses", "gplv": "gpl", "lgplv": "lgpl", "agplv": "agpl", "mplv": "mpl"}
    tokens = [re.sub(r"\.0$", "", spelled.get(t, t)) for t in tokens]
    best = {}
    for part in L.windows(tokens):
        chances = []
        for seen in [part, *(alone for _, _, alone in L.single(part, L.named(part)))]:
            there = set(seen) | {f"{seen[i]} {seen[i + 1]}" for i in range(len(seen) - 1)}
            z = [(b + sum(model.weights[model.vocabulary[g]][i] for g in there if g in model.vocabulary)) / model.temperature for i, b in enumerate(model.bias)]
            p = [1 / (1 + math.exp(-max(-60, min(60, x)))) for x in z]
            chances.append([*(x * p[-1] for x in p[:-1]), p[-1]])
        p = [max(x) for x in zip(*chances)]
        sure = {f: x for f, x in zip(model.families, p[:-1]) if x >= 0.5}
        for f, x in (sure or ({L.UNKNOWN: p[-1]} if p[-1] >= 0.5 else {})).items():
            best[f] = (L.matches(part, model.notices).get(f, 0.0), x) if f not in best else max(best[f], (L.matches(part, model.notices).get(f, 0.0), x))
    if len(best) > 1:
        best.pop(L.UNKNOWN, None)
    return {f: (round(p, 9), m) for f, (m, p) in best.items()}


def test_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    frames = [x.format(n) for n in KNOWN.values() for x in (FRAMES[0], FRAMES[3], CLEAN[1])]
    texts += [(-1 - i, " ".join(["of the code in this file by use"] * i) + f" {x}") for i, x in enumerate([*frames, "MIT or Apache 2 or LGPL licensed"])]
    model = L.fit([p for _, t in texts[::7] for p in L.passages(t)[:1]])
    got = {r["doc_id"]: r["licenses"] for r in L.scan(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    assert sum(map(len, got.values())) > 30
    for doc, text in texts:
        wanted = [(p, f, *x) for p in L.passages(text) for f, x in sorted(plain_predictions(model, p).items())]
        assert sorted((x["passage"], x["family"], round(x["probability"], 9), x["match"]) for x in got[doc]) == sorted(wanted), doc
