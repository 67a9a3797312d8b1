"""Input/output pairs: gold join, exact seeded split, one folder per split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callsift import fixed_values as V
from callsift.operators.labels import attach_gold, gold_last_wins, match_stats, to_sft_pair
from callsift.operators.splits import NAMES, split_by_order, split_sizes, with_order
from callsift.session import settle, whole_job
from callsift.sources.jsonl import DOCUMENT, GOLD, PLACE, read_jsonl_plain
from callsift.sources.publish import publish


def prepare_pairs(docs: DataFrame, gold: DataFrame, gold_order: list[str], seed: int = V.SPLIT_SEED) -> DataFrame:
    """(input, output, split) of the documents that have a gold label.

    The pairs are settled with their digest, so the join and the hashing of texts run once and the passes that find
    the cuts read one short column.
    """
    return pairs_of(docs, gold_last_wins(gold, gold_order), seed)


def pairs_of(docs: DataFrame, gold: DataFrame, seed: int = V.SPLIT_SEED) -> DataFrame:
    """prepare_pairs() for gold that has one row per id."""
    pairs = to_sft_pair(attach_gold(docs, gold))
    return split_by_order(settle(with_order(pairs, ["input", "output"], seed), "pairs"))


@whole_job
def run_prepare_pairs(
    spark: SparkSession, docs_path: str, gold_path: str, target: str, seed: int = V.SPLIT_SEED
) -> dict[str, int]:
    """Write `target/split=train|validation|test`; returns match counts and split sizes.

    Both sources are parsed once, into written tables that the counts and the join read.
    """
    docs = settle(read_jsonl_plain(spark, docs_path, DOCUMENT).select("call_id", "id", "text"), "documents")
    gold = settle(gold_last_wins(read_jsonl_plain(spark, gold_path, GOLD, with_order=True), PLACE), "gold")
    counts = match_stats(docs, gold).first().asDict()
    if not counts["matched"]:
        raise ValueError("no document has a gold label")
    pairs = pairs_of(docs, gold, seed)
    publish(spark, target, pairs.write.option("ignoreNullFields", "false").partitionBy("split").json)
    written = spark.read.schema("input STRING, output STRING, split STRING").json(target)
    sizes = {r["split"]: r["rows"] for r in split_sizes(written).collect()}
    return counts | {name: sizes.get(name, 0) for name in NAMES}
