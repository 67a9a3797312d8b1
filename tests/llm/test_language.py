"""Language identification against counting and decoding written plainly."""

import math
import zlib
from collections import Counter
from itertools import product

import pyarrow.parquet as pq

from callsift.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TRIPLES, PAIRS = 8192, 4096


def plain_counts(text):
    """Hashed triples and pairs of bytes, one by one."""
    data, gap = [32], True
    for c in text.encode():
        letter = c + 32 if 65 <= c <= 90 else c
        if 97 <= letter <= 122 or letter >= 128:
            data.append(letter)
            gap = False
        elif not gap:
            data.append(32)
            gap = True
    if not gap or len(data) == 1:
        data.append(32)
    found = Counter()
    for a, b in zip(data, data[1:]):
        found[TRIPLES + (((a * 256 + b) * 2654435761 & 0xFFFFFFFF) >> 20)] += 1
    for a, b, c in zip(data, data[1:], data[2:]):
        found[((a * 65536 + b * 256 + c) * 2654435761 & 0xFFFFFFFF) >> 19] += 1
    return found


def plain_predictions(rows):
    """(language, share) of every text: rates per language, one classifier per division, the loss of every codeword."""
    learned = {(t, x) for i, t, x in rows if t is not None and x is not None and zlib.crc32(str(i).encode()) % 4 != 2}
    languages = sorted({x for _, x in learned})
    rates = []
    for language in languages:
        total = sum((plain_counts(t) for t, x in learned if x == language), Counter())
        seen = [total[i] + 0.5 for i in range(TRIPLES + PAIRS)]
        rates.append([x / sum(total.values(), 0.5 * len(seen)) for x in seen])
    # every division of the languages with the first on the minus side
    divisions = [(-1, *rest) for rest in product((-1, 1), repeat=len(languages) - 1) if 1 in rest]
    weights, trust = [], []
    for side in divisions:
        up, down = ([r for r, s in zip(rates, side) if s == sign] for sign in (1, -1))
        w = [math.log(sum(a) / len(up)) - math.log(sum(b) / len(down)) for a, b in zip(zip(*up), zip(*down))]
        weights.append(w)
        trust.append(max(0.01, min(s * sum(x * y for x, y in zip(r, w)) for r, s in zip(rates, side))))
    mean = sum(trust) / len(trust)
    out = {}
    for i, text, _ in rows:
        if text is None or not any(c.isalpha() for c in text):
            out[i] = ("und", 0.0)
            continue
        found = plain_counts(text)
        size = max(1.0, math.sqrt(sum(found.values())))
        margins = [sum(n * w[g] for g, n in found.items()) / size for w in weights]
        loss = [sum(t / mean * (math.log1p(math.exp(-abs(m))) + max(0.0, -side[at] * m)) for t, m, side in zip(trust, margins, divisions)) for at in range(len(languages))]
        share = [math.exp(min(loss) - x) for x in loss]
        out[i] = (languages[share.index(max(share))], max(share) / sum(share))
    return out


def test_query_against_the_plain_version(spark):
    docs = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()
    wanted = plain_predictions([(r["doc_id"], r["text"], r["lang"]) for r in docs])
    got = {r["doc_id"]: r for r in QUERIES["op6_language_id"](spark, FOLDER).collect()}
    assert set(got) == set(wanted)
    for doc, (language, share) in wanted.items():
        assert got[doc]["lang_pred"] == language and abs(got[doc]["score"] - share) < 1e-9, doc
        assert got[doc]["held_out"] == (zlib.crc32(str(doc).encode()) % 4 == 2)
    assert len({x for x, _ in wanted.values()}) >= 4
