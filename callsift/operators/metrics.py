"""Classification metrics over (gold, pred) columns; a null pred is a failed call.

Every closed-vocabulary metric comes from one global (or per-group) aggregate of a few counters, so a task sends one
row however many predictions it reads.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift import fixed_values as V
from callsift.functions.answers import gold_plain


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def _sum(columns: list[Column]) -> Column:
    return reduce(add, columns)


def _counters(labels: list[str]) -> list[Column]:
    gold, pred = F.col("gold"), F.col("pred")
    answered = pred.isNotNull()
    counters = [
        F.count("*").alias("total"),
        F.count("pred").alias("answered"),
        F.count_if(gold == pred).alias("correct"),
        F.count_if(answered & ~(gold.isin(labels) & pred.isin(labels))).alias("outside"),
    ]
    for i, label in enumerate(labels):
        counters += [
            F.count_if((gold == label) & (pred == label)).alias(f"tp{i}"),
            F.count_if(pred == label).alias(f"said{i}"),
            F.count_if(answered & (gold == label)).alias(f"support{i}"),
        ]
    return counters


def _counted(df: DataFrame, labels: list[str], by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(*_counters(labels)) if by else df.agg(*_counters(labels))


def accuracy_percent(df: DataFrame) -> DataFrame:
    """One row: correct, total (answered rows), accuracy in percent, 0 for none."""
    answered = F.count("pred")
    correct = F.count_if(F.col("gold") == F.col("pred"))
    return df.agg(
        correct.alias("correct"), answered.alias("total"), (_ratio(correct, answered) * 100).alias("accuracy_percent")
    )


def accuracy(df: DataFrame) -> DataFrame:
    """One row: share of equal labels over answered rows."""
    return df.agg(_ratio(F.count_if(F.col("gold") == F.col("pred")), F.count("pred")).alias("accuracy"))


def match_rate(df: DataFrame) -> DataFrame:
    """One row: equal labels in percent of all rows, failed calls included."""
    share = _ratio(F.count_if(F.col("gold") == F.col("pred")), F.count("*"))
    return df.agg((share * 100).alias("match_rate_percentage"))


def class_report(df: DataFrame, labels: list[str] = V.LABELS, by: list[str] = []) -> DataFrame:
    """Rows (name, precision, recall, f1, support): each label, `accuracy` or `micro avg`, `macro avg`, `weighted avg`.

    The overall row is `micro avg` when labels outside the list occur, else `accuracy`; the numbers are the micro
    averages either way, which are the accuracy when nothing is outside.
    """
    n = range(len(labels))
    tp, said, support = ([F.col(f"{name}{i}") for i in n] for name in ("tp", "said", "support"))
    precision = [_ratio(tp[i], said[i]) for i in n]
    recall = [_ratio(tp[i], support[i]) for i in n]
    f1 = [_f1(precision[i], recall[i]) for i in n]
    everything = _sum(support)

    def row(name: Column, p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.struct(
            name.alias("name"), p.alias("precision"), r.alias("recall"), f.alias("f1"), s.alias("support")
        )

    def weighted(values: list[Column]) -> Column:
        return _ratio(_sum([values[i] * support[i] for i in n]), everything)

    def mean(values: list[Column]) -> Column:
        return _sum(values) / F.lit(float(len(labels)))

    micro_p, micro_r = _ratio(_sum(tp), _sum(said)), _ratio(_sum(tp), everything)
    rows = [row(F.lit(labels[i]), precision[i], recall[i], f1[i], support[i]) for i in n]
    overall = F.when(F.col("outside") > 0, "micro avg").otherwise("accuracy")
    rows.append(row(overall, micro_p, micro_r, _f1(micro_p, micro_r), everything))
    rows.append(row(F.lit("macro avg"), mean(precision), mean(recall), mean(f1), everything))
    rows.append(row(F.lit("weighted avg"), weighted(precision), weighted(recall), weighted(f1), everything))
    return _counted(df, labels, by).select(*by, F.inline(F.array(*rows)))


def run_metrics(df: DataFrame, by: list[str] = [], labels: list[str] = V.LABELS) -> DataFrame:
    """The five numbers of a run, one row per group."""
    n = range(len(labels))
    tp, said, support = ([F.col(f"{name}{i}") for i in n] for name in ("tp", "said", "support"))
    precision = [_ratio(tp[i], said[i]) for i in n]
    recall = [_ratio(tp[i], support[i]) for i in n]

    def weighted(values: list[Column]) -> Column:
        return _ratio(_sum([values[i] * support[i] for i in n]), _sum(support))

    return _counted(df, labels, by).select(
        *by,
        _ratio(F.col("correct"), F.col("answered")).alias("accuracy"),
        weighted([_f1(precision[i], recall[i]) for i in n]).alias("weighted_f1"),
        weighted(precision).alias("weighted_precision"),
        weighted(recall).alias("weighted_recall"),
        (_ratio(F.col("correct"), F.col("total")) * 100).alias("match_rate_percentage"),
    )


def weighted_prf(df: DataFrame, labels: list[str] = V.LABELS) -> DataFrame:
    """One row: support-weighted precision, recall and F1 over the listed labels."""
    return run_metrics(df, labels=labels).select("weighted_precision", "weighted_recall", "weighted_f1")


def macro_f1(df: DataFrame) -> DataFrame:
    """One row: plain mean of the F1 of every label seen as gold or pred. Pairs are counted before labels are split."""
    pairs = df.where("pred is not null").groupBy("gold", "pred").agg(F.count("*").alias("n"))
    hit = F.when(F.col("gold") == F.col("pred"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("gold").alias("label"), F.col("n"), hit.alias("tp")),
        F.struct(F.col("pred").alias("label"), F.col("n"), F.lit(0).cast("bigint").alias("tp")),
    )
    per_label = (
        pairs.select(F.inline(sides))
        .groupBy("label")
        .agg((2.0 * F.sum("tp") / F.sum("n")).alias("f1"))
    )
    return per_label.agg(F.coalesce(F.avg("f1"), F.lit(0.0)).alias("macro_f1"))


def binary_metrics(df: DataFrame, positive: str = "fraud", negative: str = "legitimate") -> DataFrame:
    """One row: tp, fp, fn, tn of exact label pairs, and accuracy over all rows, precision, recall, F1, zero-safe."""

    def pairs(gold: str, pred: str, name: str) -> Column:
        return F.count_if((F.col("gold") == gold) & (F.col("pred") == pred)).alias(name)

    counts = df.agg(
        pairs(positive, positive, "tp"),
        pairs(negative, positive, "fp"),
        pairs(positive, negative, "fn"),
        pairs(negative, negative, "tn"),
        F.count("*").alias("total"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return counts.select(
        "tp", "fp", "fn", "tn",
        _ratio(tp + tn, F.col("total")).alias("accuracy"),
        precision.alias("precision"), recall.alias("recall"), _f1(precision, recall).alias("f1"),
    )


def confusion_matrix(df: DataFrame, labels: list[str] = V.LABELS) -> DataFrame:
    """One row per gold label, one column per pred label; pairs outside the labels do not count."""

    def cell(g: int, p: int) -> Column:
        return F.count_if((F.col("gold") == labels[g]) & (F.col("pred") == labels[p])).alias(f"c{g}_{p}")

    n = range(len(labels))
    rows = [F.struct(F.lit(labels[g]).alias("gold"), *[F.col(f"c{g}_{p}").alias(labels[p]) for p in n]) for g in n]
    return df.agg(*[cell(g, p) for g in n for p in n]).select(F.inline(F.array(*rows)))


def confusion_open(df: DataFrame) -> DataFrame:
    """(gold, pred, rows) for every pair that occurs; long form, as the labels are not known beforehand."""
    return df.where("pred is not null").groupBy("gold", "pred").agg(F.count("*").alias("rows"))


def unparsed_count(df: DataFrame, word: str = "unparsed") -> DataFrame:
    return df.agg(F.count_if(F.col("pred") == word).alias("unparsed"))


def judge_pass_rate(df: DataFrame, verdict: str = "judge_score") -> DataFrame:
    """One row: passed, total and percent passed; failed rows (null verdict) count in the total."""
    passed = F.count_if(F.col(verdict) == "PASS")
    return df.agg(
        passed.alias("passed"), F.count("*").alias("total"), (_ratio(passed, F.count("*")) * 100).alias("pass_rate")
    )


def exact_match(df: DataFrame, left: str, right: str) -> DataFrame:
    """One row: share of rows whose two texts are equal after strip and lower."""
    same = gold_plain(F.col(left)) == gold_plain(F.col(right))
    return df.agg(_ratio(F.count_if(same), F.count("*")).alias("exact_match"))


def cosine(left: Column, right: Column) -> Column:
    """Cosine of two float arrays of one length, in double precision; null when a vector has no length."""

    def dot(a: Column, b: Column) -> Column:
        products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)

    return F.try_divide(dot(left, right), F.sqrt(dot(left, left)) * F.sqrt(dot(right, right)))


def fraud_counter(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(F.count_if(F.col(label) == "fraud").alias("fraud_calls_total"))
