"""Statistics of diffs and of instructions, and the filter by size of change."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.diff import diff_stats
from ..functions.text import count_lines


def with_diff(rows: DataFrame, old: str, new: str) -> DataFrame:
    """Adds the struct `diff`, computed once."""
    return rows.withColumn("diff", diff_stats(F.coalesce(F.col(old), F.lit("")), F.coalesce(F.col(new), F.lit(""))))


def filter_by_diff(rows: DataFrame, old: str = "code_before_purify", new: str = "code_after_purify", max_lines: int = 70, max_hunks: int = 7, both_sides: bool = False) -> DataFrame:
    """Rows with a change of at most so many lines and hunks. Equal texts, and those whose numbers of lines differ too much,
    cannot pass and never reach Python."""
    a, b = F.coalesce(F.col(old), F.lit("")), F.coalesce(F.col(new), F.lit(""))
    near = (a != b) & (F.abs(count_lines(a) - count_lines(b)) <= max_lines)
    if both_sides:
        near = near & (a != "") & (b != "")
    changed = F.col("diff.added") + F.col("diff.removed") + F.col("diff.modified")
    return with_diff(rows.filter(near), old, new).filter((changed > 0) & (changed <= max_lines) & (F.col("diff.hunk_num") <= max_hunks)).drop("diff")


def summary(rows: DataFrame, lines: str = "modified_lines", hunks: str = "hunks", max_lines: int = 70, max_hunks: int = 7) -> DataFrame:
    """Least, largest and median of both measures, and how many exceed the limits; exact medians."""
    over = lambda c, n: F.coalesce(F.sum(F.when(F.col(c) > n, 1).otherwise(0)), F.lit(0)).cast("long")
    share = lambda c, n: F.coalesce(F.avg(F.when(F.col(c) > n, 1.0).otherwise(0.0)), F.lit(0.0))
    out = []
    for c, n in ((lines, max_lines), (hunks, max_hunks)):
        out += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.median(c).alias(f"{c}_median"), over(c, n).alias(f"{c}_over"), share(c, n).alias(f"{c}_over_ratio")]
    return rows.agg(F.count("*").alias("n"), *out)


def histogram(rows: DataFrame, column: str, width: int) -> DataFrame:
    """bin (lower bound), n. Bins are half open, but the last one holds its upper bound. Empty bins are left out."""
    top = rows.agg(F.max(column).alias("top"))
    bins = F.greatest(F.ceil(F.col("top") / width) - 1, F.lit(0))
    return rows.select(F.col(column).alias("x")).join(F.broadcast(top)).select((F.least(F.floor(F.col("x") / width), bins) * width).cast("long").alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))


def pair_counts(rows: DataFrame, a: str = "verb", b: str = "object") -> DataFrame:
    return rows.groupBy(F.col(a).alias("verb"), F.col(b).alias("object")).agg(F.count("*").alias("n"))


def top_pairs(counts: DataFrame, verbs: int = 20, objects: int = 4, other: bool = True) -> DataFrame:
    """verb, object, n: of the commonest verbs the commonest objects, and `<other>` for the rest of a verb."""
    top = counts.groupBy("verb").agg(F.sum("n").alias("t")).orderBy(F.desc("t"), "verb").limit(verbs)
    kept = counts.join(top.select("verb"), "verb", "left_semi")
    ranked = kept.withColumn("r", F.row_number().over(Window.partitionBy("verb").orderBy(F.desc("n"), "object")))
    if not other:
        return ranked.filter(F.col("r") <= objects).select("verb", "object", "n")
    name = F.when(F.col("r") <= objects, F.col("object")).otherwise("<other>")
    return ranked.groupBy("verb", name.alias("object")).agg(F.sum("n").alias("n"))


def pair_tree(top: DataFrame) -> DataFrame:
    """The sums of the hierarchy: all, by verb, by verb and object."""
    return top.rollup("verb", "object").agg(F.sum("n").alias("n"))


def explode_pairs(rows: DataFrame, text: str, parser) -> DataFrame:
    """(verb, object) rows by a pandas UDF text -> array<struct<verb,object>>; no parser is included."""
    if parser is None:
        raise ValueError("give a pandas UDF that finds verbs and their objects; no language model is included")
    return rows.select(F.explode(parser(F.col(text))).alias("p")).select(F.lower("p.verb").alias("verb"), F.lower("p.object").alias("object"))
