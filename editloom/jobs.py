"""Jobs from YAML files: ``python -m editloom.jobs <job> <config.yaml>``.

extract: input, output. mix: input_files, ratios, instr_types, model_names, output_file, total_samples, random_seed.
filter: jsonl_path, field_name, data_format, random_seed, filter_settings, output_path. finetune: input_files, output_file,
format, random_seed, no_thinking_tag. report: paths, output, k, v1_only, all_folders.
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import schemas
from .operators import counters, evalmetrics, extract, mix, topics
from .sources import io


def _triplets(spark: SparkSession, path: str):
    return io.with_row_id(io.normalise(io.read_jsonl(spark, path, schemas.CLEAN)))


def run_extract(spark: SparkSession, c: dict) -> None:
    rows = io.normalise(io.read_jsonl(spark, c["input"], schemas.RESPONSE))
    one, two = (F.coalesce(F.col(c), F.lit("")) for c in ("response_1", "response_2"))
    rows, seen = counters.kept_and_skipped(rows, extract.has_sections(one, two), "responses", no_first=one == "", no_second=two == "")
    io.write_jsonl(extract.triplets(rows).drop("system", "user", "response", "sample_index", "commit_message"), c["output"])
    print(", ".join(f"{k} {v}" for k, v in seen.get.items()))


def run_mix(spark: SparkSession, c: dict) -> None:
    lists = [c[k] for k in ("input_files", "ratios", "instr_types", "model_names")]
    if len({len(x) for x in lists}) != 1:
        raise ValueError("input_files, ratios, instr_types and model_names must be of one length")
    sources = [mix.Source(_triplets(spark, p), r, k, m) for p, r, k, m in zip(*lists, strict=True)]
    io.write_jsonl(mix.mix(sources, c["total_samples"], c.get("random_seed", 42)).drop("row_id"), c["output_file"])


def run_filter(spark: SparkSession, c: dict) -> None:
    s = c.get("filter_settings", {})
    rows = io.with_row_id(io.read_jsonl(spark, c["jsonl_path"], schemas.MIX))
    kept = topics.diversity_filter(
        rows, mix.loader_text(rows, c["field_name"], c.get("data_format", "general")), "row_id", c.get("random_seed", 42), s.get("max_modify_lines", 70), s.get("max_hunk_num", 7),
        s.get("max_samples_total", 10_000), s.get("max_samples_per_topic"), s.get("topics", 20), s.get("cache"),
    )
    io.write_jsonl(kept.drop("row_id"), c["output_path"])


def run_finetune(spark: SparkSession, c: dict) -> None:
    inputs = [io.with_row_id(io.normalise(io.read_jsonl(spark, p, schemas.MIX))) for p in c["input_files"]]
    io.write_jsonl(mix.finetune_set(inputs, c.get("format", "share_gpt"), c.get("random_seed", 42), no_think=c.get("no_thinking_tag", False)).drop("row_id"), c["output_file"])


def run_report(spark: SparkSession, c: dict) -> None:
    rows = io.read_results(spark, c["paths"], schemas.RESULT)
    rows = (io.leaf_folders(rows) if c.get("all_folders") else rows).withColumn("row_id", F.xxhash64("folder", "id", "instr_kind"))
    rows = evalmetrics.per_problem(rows)
    sheet = evalmetrics.as_sheet(evalmetrics.by_directory(evalmetrics.v1_only(rows) if c.get("v1_only") else rows, tuple(c.get("k") or (1,))))
    io.append_sheet(sheet, c["output"])
    print(io.to_csv(sheet), end="")


JOBS = {
    "extract": (run_extract, ("input", "output")),
    "mix": (run_mix, ("input_files", "ratios", "instr_types", "model_names", "output_file", "total_samples")),
    "filter": (run_filter, ("jsonl_path", "field_name", "output_path")),
    "finetune": (run_finetune, ("input_files", "output_file")),
    "report": (run_report, ("paths", "output")),
}


def main(args: list[str]) -> int:
    if len(args) != 2 or args[0] not in JOBS:
        print(__doc__, file=sys.stderr)
        return 2
    job, needed = JOBS[args[0]]
    job(SparkSession.builder.appName(f"editloom {args[0]}").getOrCreate(), io.read_config(args[1], needed))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
