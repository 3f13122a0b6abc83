"""pass@k, excess code and coverage of benchmark results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.diff import differ_lines

V1_IDS = (1, 3, 4, *range(6, 27), *range(28, 42), *range(44, 54), *range(55, 59), 60)
DEFAULT_TEMPERATURE = 0.2


def pass_at_k(n: Column, c: Column, k: int | Column) -> Column:
    """Chance that k of n completions, of which c pass, hold one that passes."""
    k = F.lit(k) if isinstance(k, int) else k
    product = F.aggregate(F.sequence((n - c + 1).cast("long"), n.cast("long")), F.lit(1.0), lambda a, i: a * (1 - k / i))
    return F.when(c <= 0, F.when(n < k, 1.0).otherwise(0.0)).when(n - c < k, 1.0).otherwise(1 - product)


def passed(r: Column) -> Column:
    return F.coalesce((r["status"] == "OK") & (r["exit_code"] == 0), F.lit(False))


def per_problem(results: DataFrame) -> DataFrame:
    """Adds n, c, mean_excess and median_coverage (share not covered) per result file; row_id must name it.

    The excess of a completion is its uncovered lines over all lines of the comparison with the code before; without any
    line it is null.
    """
    rows = results.withColumns({"n": F.size("results"), "c": F.size(F.filter("results", passed)), "temperature": F.coalesce("temperature", F.lit(DEFAULT_TEMPERATURE))})
    covered = rows.select("row_id", "before", F.explode(F.filter("results", lambda r: passed(r) & r["coverage"].isNotNull())).alias("r"))
    covered = covered.withColumn("lines", differ_lines("before", "r.program_no_test"))
    measures = covered.groupBy("row_id").agg(F.avg(F.size("r.coverage_missing") / F.nullif("lines", F.lit(0))).alias("mean_excess"), F.median(100 - F.col("r.coverage")).alias("median_coverage"))
    return rows.join(measures, "row_id", "left")


def v1_only(problems: DataFrame) -> DataFrame:
    return problems.filter(F.col("id").isin(*V1_IDS))


def by_directory(problems: DataFrame, ks=(1,), keys=("directory", "name")) -> DataFrame:
    """One row a directory and k. Directories with other than one temperature are left out. Missing measures are null."""
    m = F.col("mean_excess")
    every = problems.groupBy(*keys)
    base = every.agg(
        F.count_distinct("temperature").alias("t"),
        F.count("*").alias("num_problems"),
        F.min("n").alias("min_completions"),
        F.max("n").alias("max_completions"),
        F.bround(F.avg(m) * 100, 6).alias("excess_code"),
        F.bround(F.stddev_pop(m) / F.sqrt(F.count(m)) * 100, 6).alias("excess_code_se"),
        F.bround(F.avg("median_coverage"), 6).alias("mean_median_coverage"),
        *(F.bround(F.avg(pass_at_k(F.col("n"), F.col("c"), k)) * 100, 6).alias(f"k{k}") for k in ks),
    ).filter("t = 1")
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("estimate")) for k in ks))).alias("p")
    return base.select(*keys, "num_problems", "min_completions", "max_completions", "excess_code", "excess_code_se", "mean_median_coverage", pairs).select("*", "p.k", "p.estimate").drop("p")


def as_sheet(rows: DataFrame) -> DataFrame:
    """The columns of the results sheet."""
    names = {"directory": "Directory", "name": "Name", "k": "Pass@k", "estimate": "Estimate", "num_problems": "NumProblems", "min_completions": "MinCompletions", "max_completions": "MaxCompletions", "excess_code": "ExcessCode", "excess_code_se": "ExcessCodeSE", "mean_median_coverage": "MeanMedianCoverage"}
    return rows.select(*(F.col(f"`{a}`").alias(b) for a, b in names.items()))
