"""Language identification by error-correcting output codes over byte n-grams."""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsift.llm.base import map_columns, rows_of, slices, utf8

UNKNOWN = "und"
TRIPLES, PAIRS = 8192, 4096
FEATURES = TRIPLES + PAIRS
#: Distinct texts per language that the classifiers learn from, about; whole texts, chosen by a hash of the row.
SAMPLE = 20_000
#: A prediction whose share is under this is flagged as ambiguous.
LEAST_SCORE = 0.6

#: ASCII letters in lower case and bytes of other characters; everything else is a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def features(text: str) -> np.ndarray:
    """Counts of hashed byte triples and pairs of the whole text, with single spaces between words."""
    data = np.frombuffer(b" " + b" ".join(utf8(text).translate(_FOLD).split()) + b" ", np.uint8).astype(np.uint32)
    pairs = (data[:-1] << np.uint32(8)) | data[1:]
    triples = (pairs[:-1] << np.uint32(8)) | data[2:]
    mix = np.uint32(2654435761)
    codes = np.concatenate([(triples * mix) >> np.uint32(19), ((pairs * mix) >> np.uint32(20)) + np.uint32(TRIPLES)])
    return np.bincount(codes, minlength=FEATURES)


def codewords(n: int) -> np.ndarray:
    """One row of +1 and -1 per language: all divisions for up to five languages, else drawn far apart."""
    if n <= 5:
        columns = range(1, 1 << max(0, n - 1))
        return np.array([[1 if i and (c >> i - 1) & 1 else -1 for c in columns] for i in range(n)]).reshape(n, -1)
    bits = max(15, 10 * int(np.ceil(np.log2(n))))
    for seed in range(1000):
        rows = np.array([[random.Random(f"{seed}:{i}:{b}").choice((1, -1)) for b in range(bits)] for i in range(n)])
        apart = (bits - rows @ rows.T) // 2 + bits * np.eye(n, dtype=int)
        if apart.min() >= bits // 5 and (abs(rows.sum(axis=0)) < n).all():
            return rows
    raise ValueError(f"no code for {n} languages")


@dataclass
class Model:
    """languages; codes (language x bit); weights (feature x bit); trust (bit): how well each classifier divides."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    def scores(self, text: str) -> np.ndarray:
        """Share of each language, from the loss of its codeword under the classifiers' margins."""
        found = features(text)
        margin = (found @ self.weights) / max(1.0, np.sqrt(found.sum()))
        loss = (np.logaddexp(0, -self.codes * margin) * self.trust).sum(axis=1)
        share = np.exp(-(loss - loss.min()))
        return share / share.sum()


def train(df: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """Learn from the rows' texts and non-null languages, about `sample` distinct texts of each language and one at least.

    Copies count once, so that no text rules a language's rates and the sample is bounded whatever the copies are.
    Tasks count n-grams per language; only languages x FEATURES counts reach the driver. Each bit's classifier is linear
    with the log-odds of an n-gram among the languages on either side, every language weighing the same.
    """
    labelled = df.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    place = F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 30))
    distinct = labelled.select("lang", F.xxhash64("text", "lang").alias("row"), place.alias("place")).distinct()
    sizes = {r["lang"]: (r["n"], r["first"]) for r in distinct.groupBy("lang").agg(F.count("*").alias("n"), F.min("place").alias("first")).collect()}
    if not sizes:
        return Model([], np.zeros((0, 0)), np.zeros((FEATURES, 0)), np.zeros(0))
    limit = F.create_map(*[F.lit(x) for k, (n, first) in sizes.items() for x in (k, max(first + 1.0, min(1.0, sample / n) * (1 << 30)))])
    drawn = labelled.where(place < limit[F.col("lang")]).distinct()

    def count(batches):
        import pyarrow as pa

        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for value, name in rows_of({x: batch.column(x) for x in ("text", "lang")}, ("text", "lang")):
                found = features(value)
                total[name] = total[name] + found if name in total else found
        for name, found in total.items():
            where = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(where), pa.string()), pa.array(where, pa.int32()), pa.array(found[where], pa.int64())],
                names=["lang", "feature", "n"],
            )

    counted = drawn.mapInArrow(count, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(set(counted["lang"]))
    seen = np.zeros((len(languages), FEATURES))
    seen[[languages.index(x) for x in counted["lang"]], counted["feature"]] = counted["n"]
    seen[:, :TRIPLES] += 0.5
    seen[:, TRIPLES:] += 0.5
    rates = seen / seen.sum(axis=1, keepdims=True)
    codes = codewords(len(languages))
    weights = np.zeros((FEATURES, codes.shape[1]))
    for b in range(codes.shape[1]):
        up, down = codes[:, b] > 0, codes[:, b] < 0
        weights[:, b] = np.log(rates[up].mean(axis=0)) - np.log(rates[down].mean(axis=0))
    trust = np.array([(codes[:, b] * (rates @ weights[:, b])).min() for b in range(codes.shape[1])])
    trust = np.clip(trust, 0.01, None)
    return Model(languages, codes, weights, trust / trust.mean() if len(trust) else trust)


def predict(df: DataFrame, model: Model, text: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """Adds (or replaces) lang_pred, score (0 to 1) and ambiguous; the text is the only input of a prediction.

    Null texts and texts without a letter are `und` with score 0, and so is everything under a model without languages.
    The model (languages x bits and features x bits) is broadcast; its size is fixed by the number of languages.
    """
    made = T._parse_datatype_string("lang_pred string, score double, ambiguous boolean")
    rest = [f for f in df.schema.fields if f.name not in made.names]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def one(value):
        known = shared.value
        if value is None or not known.languages or not any(map(str.isalpha, value)):
            return UNKNOWN, 0.0, True
        share = known.scores(value)
        best = int(np.argmax(share))
        return known.languages[best], float(share[best]), bool(share[best] < least)

    def make():
        def work(columns):
            for some in slices(columns):
                found = zip(*map(one, some[text].to_pylist()))
                yield {f.name: some[f.name] for f in rest} | dict(zip(made.names, map(list, found)))

        return work

    return map_columns(df.select(*[F.col(f"`{f.name}`") for f in rest]), make, T.StructType(rest + made.fields))
