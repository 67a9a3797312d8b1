"""Time the headline queries: one JSON line with seconds per query (best of two runs, full output consumed)."""

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from callsift import workload  # noqa: E402
from callsift.session import local_session  # noqa: E402

HEADLINE = [
    "curate_documents", "curate_noisy", "mask_pii", "repair_unicode", "compliance_check", "inject_noise", "duplicate_groups",
    "keep_first_duplicate", "curation_stats", "add_id", "flatten_transcript", "attach_gold", "gold_last_wins", "match_stats",
    "seeded_split_exact", "prepare_pairs", "leakage_check", "parse_contains", "parse_result_tag", "class_report", "run_metrics",
    "macro_f1", "messages_eval_few_shot", "prompt_plan", "clean_answer", "first_accepted_attempt", "score_with", "evaluate_modes",
    "judge_flow", "read_jsonl_strict", "write_curated", "semantic_similarity", "stream_fraud_counter", "stream_curate_rows",
]


def seconds(spark, query, folder):
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def dealt(spark, folder, files):
    """A copy of the tables over several files, as a large table has; queries take the plan of a large table only."""
    target = tempfile.mkdtemp(prefix="callsift-bench-")
    for path in sorted(Path(folder).glob("*.parquet")):
        spark.read.parquet(str(path)).repartitionByRange(files, F.col(spark.read.parquet(str(path)).columns[0])).write.parquet(f"{target}/{path.name}")
    return target


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("callsift-bench", cores, int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    scale = Path(folder).name.removeprefix("sf")
    folder = dealt(spark, folder, int(cores) if cores.isdigit() else 8)
    seconds(spark, workload.QUERIES["curate_documents"], folder)  # start the JVM's compilers and Python workers
    times = {name: round(min(seconds(spark, workload.QUERIES[name], folder) for _ in range(2)), 3) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
