"""Exact sampling and quotas. Random order is the order of md5(seed # key): the same for any partitioning and in any engine."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import LINE_END


def order_key(seed, *keys: Column) -> Column:
    return F.md5(F.concat_ws("#", F.lit(str(seed)), *(k.cast("string") for k in keys)))


def draw(seed, *keys: Column) -> Column:
    """A number of 28 bits from a seed and keys."""
    return F.conv(F.substring(order_key(seed, *keys), 1, 7), 16, 10).cast("long")


def sample_exact(df: DataFrame, n: int, key: str, seed: int, strict: bool = False, extra=()) -> DataFrame:
    """Exactly n rows without replacement (all, if there are fewer; an error if strict), in random order.

    A large sample first drops what cannot be in it: the fraction wanted plus ten standard deviations of hashes stays.
    """
    total = df.count() if strict or n > 20_000 else None
    if strict and n > total:
        raise ValueError(f"{n} rows wanted, {total} there")
    k = order_key(seed, *(F.col(c) for c in (key, *extra)))
    if total and n < total:
        share = n / total + 10 * math.sqrt(n) / total
        if share < 1:
            df = df.filter(draw(seed, *(F.col(c) for c in (key, *extra))) < math.ceil(share * 16**7))
    return df.orderBy(k, key).limit(n)


def shuffle(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.orderBy(order_key(seed, F.col(key)), key)


def with_snippet(rows: DataFrame, text: str, seed, key: Column, name: str = "snippet", low: int = 5, high: int = 15) -> DataFrame:
    """Adds a run of low..high lines of `text` at a drawn place; rows with fewer lines, or none, drop out.

    The text is split once: nothing is computed again below the generator that hands the lines on.
    """
    rows = rows.withColumn("parts_", F.explode(F.array(F.split(F.coalesce(F.col(text), F.lit("")), LINE_END))))
    total = F.size("parts_") - (F.element_at("parts_", -1) == "").cast("int")
    rows = rows.withColumn("total_", F.explode(F.array(total))).filter(F.col("total_") >= low)
    size = low + F.pmod(draw(f"{seed}l", key), (F.least(F.lit(high), F.col("total_")) - low + 1).cast("long"))
    rows = rows.withColumn("size_", F.explode(F.array(size)))
    start = F.pmod(draw(f"{seed}s", key), (F.col("total_") - F.col("size_") + 1).cast("long"))
    return rows.withColumn(name, F.array_join(F.slice("parts_", (start + 1).cast("int"), F.col("size_").cast("int")), "\n")).drop("parts_", "total_", "size_")


def largest_remainder(ratios: list[float], total: int) -> list[int]:
    """Whole quotas that sum to the total: the integer parts, and one more for the largest fractions, the first of equals."""
    if abs(sum(ratios) - 1) > 1e-6:
        raise ValueError("ratios must sum to 1")
    exact = [Fraction(str(r)) * total for r in ratios]
    out = [int(x) for x in exact]
    for i in sorted(range(len(out)), key=lambda i: (-(exact[i] - out[i]), i))[: total - sum(out)]:
        out[i] += 1
    return out


def water_fill(sizes: DataFrame, most: int, cap: int | None = None) -> DataFrame:
    """sizes (topic, size, first_row) -> quota per topic: topics that fit an equal share are taken whole, the others share
    the rest equally, one more for the first in order of appearance. If all fit, all are taken.

    In order of size a topic fits while size * topics left <= what is left; one window over the table of topics tells. That
    table has a row a topic and lies in one partition, as a quota over all topics must.
    """
    by_size = Window.orderBy("size", "first_row", "topic")
    ranked = sizes.select("topic", "size", "first_row", F.row_number().over(by_size).alias("r"), F.count("*").over(Window.partitionBy()).alias("topics"), F.coalesce(F.sum("size").over(by_size.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    fits = F.col("size") * (F.col("topics") - F.col("r") + 1) <= most - F.col("before")
    ranked = ranked.withColumn("fits", fits)
    failed = F.coalesce(F.max((~F.col("fits")).cast("int")).over(by_size.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    locked = ranked.withColumn("locked", failed == 0)
    everything = Window.partitionBy()
    room = most - F.coalesce(F.sum(F.when(F.col("locked"), F.col("size"))).over(everything), F.lit(0))
    many = F.sum(F.when(F.col("locked"), 0).otherwise(1)).over(everything)
    rest = locked.withColumns({"room": room, "many": many, "place": F.row_number().over(Window.partitionBy("locked").orderBy("first_row", "topic"))})
    each = F.floor(F.col("room") / F.col("many"))
    quota = F.when(F.col("locked"), F.col("size")).otherwise(each + (F.col("place") <= F.col("room") - each * F.col("many")).cast("int")).cast("long")
    if cap is not None:
        quota = F.least(quota, F.lit(cap).cast("long"))
    return rest.select("topic", "size", quota.alias("quota"))


def balanced_sample(rows: DataFrame, topic: str, row_id: str, seed: int, most: int | None = None, cap: int | None = None) -> DataFrame:
    """Rows of each topic up to its quota, drawn at random within the topic.

    Within a topic the quota cuts the order of hashes. The window is per topic; a topic too large for that is first cut by
    hash to its quota, ten standard deviations and 60 rows, so that the chance of a topic short of its quota is below
    10^-14 for any quota.
    """
    if most is None and cap is None:
        raise ValueError("give most or cap")
    sizes = rows.groupBy(F.col(topic).alias("topic")).agg(F.count("*").alias("size"), F.min(row_id).alias("first_row"))
    quotas = water_fill(sizes, most, cap) if most is not None else sizes.select("topic", "size", F.least("size", F.lit(cap)).alias("quota"))
    key = order_key(seed, F.col(row_id))
    kept = rows.join(quotas, rows[topic].eqNullSafe(quotas["topic"]))
    chance = (F.col("quota") + 10 * F.sqrt(F.col("quota")) + 60) / F.col("size")
    kept = kept.filter((F.col("size") <= 10_000) | (draw(seed, F.col(row_id)) < chance * 16**7))
    place = F.row_number().over(Window.partitionBy(quotas["topic"]).orderBy(key, row_id))
    return kept.withColumn("place_", place).filter("place_ <= quota").select(*(rows[c] for c in rows.columns))
