"""Prompts from pairs of commits, or from a commit and its diff."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import templates
from ..functions.diff import unified_diff
from ..functions.text import split_lines
from .sampling import draw, order_key, with_snippet


def valid_commits(commits: DataFrame, rewrite: bool = False) -> DataFrame:
    """Commits whose fields are there; for rewriting the message counts instead of the commit's id."""
    fields = ("old_contents", "new_contents", "message" if rewrite else "commit")
    keep = F.lit(True)
    for f in fields:
        keep = keep & (F.coalesce(F.length(f), F.lit(0)) > 0)
    return commits.filter(keep)


def eligible(commits: DataFrame, low: int = 5) -> DataFrame:
    return valid_commits(commits).filter(F.size(split_lines(F.col("old_contents"))) >= low)


def numbered(pool: DataFrame, key: str, seed, digits: int = 3) -> DataFrame:
    """Places 0.. in a random order that does not depend on partitions.

    Hashes are uniform, so their first digits cut the rows into even buckets. Buckets are numbered by a window each, behind
    as many rows as the buckets before hold; that table has 16^digits rows at most. Five digits keep a bucket of 10^10
    rows at ten thousand.
    """
    hashed = pool.withColumn("o_", order_key(seed, F.col(key))).withColumn("b_", F.substring("o_", 1, digits))
    counts = hashed.groupBy("b_").agg(F.count("*").alias("n"))
    before = counts.select("b_", (F.sum("n").over(Window.orderBy("b_")) - F.col("n")).alias("base_"))
    place = F.col("base_") + F.row_number().over(Window.partitionBy("b_").orderBy("o_", key)) - 1
    return hashed.join(F.broadcast(before), "b_").withColumn("place", place).drop("o_", "b_", "base_")


def pairs(n_pool: int, n: int, seed, spark) -> DataFrame:
    """n pairs of different places: i, a, b."""
    rows = spark.range(n).select(F.col("id").alias("i"))
    a = F.pmod(draw(f"{seed}a", F.col("i")), F.lit(n_pool))
    step = 1 + F.pmod(draw(f"{seed}b", F.col("i")), F.lit(max(1, n_pool - 1)))
    return rows.select("i", a.alias("a"), F.pmod(a + step, F.lit(n_pool)).alias("b"))


def synthesis_prompts(commits: DataFrame, shots: DataFrame, n: int | None, seed: int = 42, low: int = 5, high: int = 15, version: str = "v5.1", n_pool: int | None = None) -> DataFrame:
    """Exactly n prompts, each of two different eligible commits and a one-shot example drawn at random. Without n there are
    as many prompts as eligible commits."""
    spark = commits.sparkSession
    system, turns = templates.prompts(version)
    pool = numbered(eligible(commits, low), "commit", seed).select("place", "commit", "old_contents", "message")
    size = pool.count() if n_pool is None else n_pool
    if size < 2:
        raise ValueError("two eligible commits are needed")
    shots = numbered(shots, "code_before", seed).select(F.col("place").alias("shot"), "code_before", "instruct_descriptive", "instruct_lazy")
    many = shots.count()
    side = lambda s: pool.select(*(F.col(c).alias(f"{c}_{s}") for c in pool.columns))
    rows = pairs(size, size if n is None else n, seed, spark).withColumn("shot", F.pmod(draw(f"{seed}o", F.col("i")), F.lit(many)))
    rows = rows.join(side("a"), F.col("a") == F.col("place_a")).join(side("b"), F.col("b") == F.col("place_b")).join(shots, "shot")
    for s in "ab":
        rows = with_snippet(rows, f"old_contents_{s}", seed, F.concat_ws("#", "i", F.lit(s)), f"snippet_{s}", low, high)
    slots = {"code_snippet_1": F.col("snippet_a"), "code_snippet_2": F.col("snippet_b"), "code_before_shot": F.col("code_before"), "desc_instr_shot": F.col("instruct_descriptive"), "lazy_instr_shot": F.col("instruct_lazy")}
    return rows.select(
        "i",
        F.array("commit_a", "commit_b").alias("commit"),
        F.lit(system).alias("system"),
        F.array(*(templates.fill(t, **slots) for t in turns)).alias("user"),
        F.array("snippet_a", "snippet_b").alias("code_snippet"),
        F.array("message_a", "message_b").alias("commit_message"),
    )


def rewrite_prompts(commits: DataFrame, shots: DataFrame, seed: int = 42, version: str = "v5.9") -> DataFrame:
    """One prompt per commit with a message, from its diff."""
    system, turns = templates.prompts(version)
    shots = numbered(shots, "code_before", seed).select(F.col("place").alias("shot"), F.col("instruct_descriptive").alias("shot_desc"), F.col("instruct_lazy").alias("shot_lazy"))
    many = max(1, shots.count())
    rows = valid_commits(commits, rewrite=True).withColumn("shot", F.pmod(draw(f"{seed}o", F.col("commit")), F.lit(many))).join(shots, "shot")
    rows = rows.withColumn("diff", unified_diff("old_contents", "new_contents"))
    text = templates.fill(turns[0], code_before=F.col("old_contents"), code_diff=F.col("diff"), commit_message=F.col("message"), desc_instr_shot=F.col("shot_desc"), lazy_instr_shot=F.col("shot_lazy"))
    return rows.select("commit", F.lit(system).alias("system"), text.alias("user"), F.col("old_contents").alias("old_code"), F.col("new_contents").alias("new_code"), F.col("message").alias("commit_message"))
