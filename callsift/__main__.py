"""Run a job on JSON Lines data sets.

`callsift JOB ...` or `python -m callsift JOB ...` where the package is installed; on a cluster
`spark-submit --py-files callsift.zip callsift/__main__.py JOB ...`, which also ships the package to the executors.
Models come in by the dotted name of a factory, `package.module:function`, importable on the executors.
"""

from __future__ import annotations

import argparse
import importlib
import json

from pyspark.sql import SparkSession

from callsift import fixed_values as V
from callsift.plans.curate import run_curation
from callsift.plans.evaluate import evaluate, infer, judge
from callsift.plans.generate import generate, plan_samples
from callsift.plans.noise import run_noise
from callsift.plans.pairs import run_prepare_pairs
from callsift.operators.ids import number_by_position
from callsift.session import settle, whole_job
from callsift.sources.jsonl import DOCUMENT, PLACE, bad_lines, read_jsonl_plain, write_jsonl
from callsift.sources.publish import publish
from callsift.sources.reports import CONTENT, append_pair_sink, write_report_csv

PAIR_WITH_ID = "id STRING, input STRING, output STRING"


def named(path: str):
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="callsift")
    jobs = parser.add_subparsers(dest="job", required=True)
    places = {
        "noise": ["source", "target"],
        "curate": ["source", "target"],
        "pairs": ["documents", "gold", "target"],
        "evaluate": ["pairs", "metrics"],
        "judge": ["pairs", "report"],
        "infer": ["source", "target"],
        "generate": ["transcripts", "gold"],
        "bad-lines": ["source", "target"],
    }
    for job, names in places.items():
        part = jobs.add_parser(job)
        for name in names:
            part.add_argument(name)
    for job in ("noise", "pairs", "generate"):
        jobs.choices[job].add_argument("--seed", type=int, default=V.SPLIT_SEED)
    for job in ("evaluate", "judge", "infer", "generate"):
        jobs.choices[job].add_argument("--model", required=True, help="package.module:factory")
        jobs.choices[job].add_argument("--tasks", type=int, help="how many clients work at once")
        jobs.choices[job].add_argument("--ledger", help="folder that keeps answers, so that no run asks twice")
    for job in ("judge", "generate"):
        jobs.choices[job].add_argument("--judge-model", required=True)
    jobs.choices["evaluate"].add_argument("--run", help="run id; running again under it replaces its metrics")
    jobs.choices["evaluate"].add_argument("--model-name", default="")
    jobs.choices["generate"].add_argument("--samples", type=int, default=10)
    jobs.choices["generate"].add_argument("--source-name", required=True)
    return parser.parse_args(argv)


@whole_job
def run(spark: SparkSession, chosen: argparse.Namespace) -> dict:
    job = chosen.job
    if job == "noise":
        return run_noise(spark, chosen.source, chosen.target, chosen.seed)
    if job == "curate":
        return run_curation(spark, chosen.source, chosen.target)
    if job == "pairs":
        return run_prepare_pairs(spark, chosen.documents, chosen.gold, chosen.target, chosen.seed)
    if job == "bad-lines":
        publish(spark, chosen.target, lambda beside: write_jsonl(bad_lines(spark, chosen.source), beside))
        return {"bad_lines": spark.read.text(chosen.target).count()}
    model = named(chosen.model)
    scoring = {"tasks": chosen.tasks, "ledger": chosen.ledger, "model": chosen.model}
    if job == "evaluate":
        rows = read_jsonl_plain(spark, chosen.pairs, "input STRING, output STRING")
        options = {"run": chosen.run, "model_name": chosen.model_name, "dataset_file": chosen.pairs, **scoring}
        return {r["mode"]: r.asDict() for r in evaluate(rows, model, chosen.metrics, **options).collect()}
    if job == "judge":
        rows = number_by_position(read_jsonl_plain(spark, chosen.pairs, PAIR_WITH_ID, with_order=True), "place").drop(*PLACE)
        report = settle(judge(rows, model, named(chosen.judge_model), ["place"], judge_name=chosen.judge_model, **scoring), "report")
        write_report_csv(report, chosen.report)
        return {"rows": report.count()}
    if job == "infer":
        rows = read_jsonl_plain(spark, chosen.source, DOCUMENT).select("call_id", "id", "text")
        publish(spark, chosen.target, lambda beside: write_jsonl(infer(rows, model, **scoring), beside))
        return {"rows": spark.read.text(chosen.target).count()}
    plan = plan_samples(spark.range(1, chosen.samples + 1), "id", chosen.seed)
    made = settle(generate(plan, model, named(chosen.judge_model), chosen.source_name, seed=chosen.seed, judge_name=chosen.judge_model, **scoring), "made")
    append_pair_sink(made, chosen.transcripts, chosen.gold, chosen.source_name, CONTENT)
    return {"accepted": made.count()}


def main() -> None:
    print(json.dumps(run(SparkSession.builder.appName("callsift").getOrCreate(), arguments()), default=str))


if __name__ == "__main__":
    main()
