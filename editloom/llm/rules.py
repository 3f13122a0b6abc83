"""Quality rules whose thresholds come from quantile sketches per language and source.

A sketch is a DDSketch: counts of logarithmic buckets, here one row a bucket, so that merging is adding and partial sketches
combine before the shuffle. Its quantiles are within ALPHA of the true ones, relatively, and do not depend on the order of
rows. The quantiles of a group of n documents are drawn towards those of its language, and these towards those of all, with
the weight of PRIOR documents to n: a small group hardly has thresholds of its own, a large one nothing else.

The fence of a measure lies REACH times the distance of the OUTER quantile from the median beyond the median; no part of it
is fixed. A document fails if a measure leaves its fence by more than NOISE standard deviations of what counting in a text
of its length can do: that of a Poisson count for shares, of a mean of exponential lengths for the length of words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, materialise, texts

ALPHA = 0.01
GAMMA = (1 + ALPHA) / (1 - ALPHA)
TINY = 1e-6
PRIOR, OUTER, REACH, NOISE = 200.0, 0.85, 12.0, 4.0
MIN_WORDS, MAX_REPEAT = 50, 0.5
#: measure -> (count, what it is a share of)
MEASURES = {
    "symbols": ("n_symbols", "word_chars"),
    "duplicate_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "capitals": ("n_capitals", "word_chars"),
    "exclamations": ("n_exclamations", "word_chars"),
    "word_length": ("word_chars", "n_words"),  # no share: two-sided
}
SPACES = " \t\n\x0b\x0c\r"
CAPITALS = bytes(range(65, 91))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_exclamations")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    m = len(number)
    if m == n:
        return 0
    pair = ids[:-2] * m + ids[1:-1]
    if m < 2_000_000:
        key = pair * m + ids[2:]
    else:  # the product of three would not fit: number the pairs first
        key = np.unique(pair, return_inverse=True)[1] * m + ids[2:]
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[inverse] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : k + n - 2] |= twice
    return int(covered.sum())


def counts(text: str) -> tuple[int, ...]:
    raw = text.encode()
    words = raw.split()
    seen: set[str] = set()
    lines = same = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            if line in seen:
                same += 1
            else:
                seen.add(line)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, "#*$%&|<>")),
        same,
        repeated_words(words),
        lines,
        len(raw) - len(raw.translate(None, CAPITALS)),
        text.count("!") + text.count("?"),
    )


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source (null as empty) and the COUNTS of each whole text."""

    def block(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = [counts(x) for x in batch.column("text").to_pylist()]
        columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), batch.column("source"), *columns], ["doc_id", "lang", "source", *COUNTS])

    named = texts(docs, *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")))
    return map_arrow(named, block, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS))


def with_measures(counted: DataFrame) -> DataFrame:
    return counted.withColumns({m: F.col(a) / F.greatest(F.col(b), F.lit(1)) for m, (a, b) in MEASURES.items()})


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, measure, bucket, n: one DDSketch a group and measure. Merging sketches is summing n by bucket."""
    rows = measured.select("lang", "source", F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("x")) for m in MEASURES))).alias("v"))
    bucket = F.when(F.col("v.x") <= TINY, F.lit(None)).otherwise(F.ceil(F.log(F.col("v.x")) / math.log(GAMMA))).cast("int")
    return rows.groupBy("lang", "source", F.col("v.measure").alias("measure"), F.coalesce(bucket, F.lit(-(2**31))).alias("bucket")).agg(F.count("*").alias("n"))


def quantiles(sketch: DataFrame, *by: str) -> DataFrame:
    """Documents, median and both outer quantiles of each sketch after merging it by the given columns. A sketch has at most
    a few thousand buckets, so the window over one is small."""
    merged = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")
    upto = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = merged.select(*by, "measure", "bucket", "n", upto.alias("upto"), F.sum("n").over(group).alias("total"))
    value = F.when(F.col("bucket") == -(2**31), 0.0).otherwise(2 * F.pow(F.lit(GAMMA), F.col("bucket")) / (GAMMA + 1))
    at = lambda q: F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * q), value))
    return ranked.groupBy(*by, "measure").agg(F.max("total").alias("n"), at(1 - OUTER).alias("low"), at(0.5).alias("mid"), at(OUTER).alias("high"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """lang, source and <measure>_low, _mid, _high for each group: both fences and the median."""
    own, of_lang, of_all = quantiles(sketch, "lang", "source"), quantiles(sketch, "lang"), quantiles(sketch)
    prefix = lambda df, p: df.select(*(F.col(c).alias(c if c in ("lang", "source", "measure") else p + c) for c in df.columns))
    rows = prefix(own, "a_").join(prefix(of_lang, "b_"), ["lang", "measure"]).join(F.broadcast(prefix(of_all, "c_")), "measure")  # one row a measure
    drawn = lambda n, x, y: (F.col(n) * x + PRIOR * y) / (F.col(n) + PRIOR)
    rows = rows.select("lang", "source", "measure", *(drawn("a_n", F.col(f"a_{q}"), drawn("b_n", F.col(f"b_{q}"), F.col(f"c_{q}"))).alias(q) for q in ("low", "mid", "high")))
    fences = {"low": F.col("mid") - REACH * (F.col("mid") - F.col("low")), "mid": F.col("mid"), "high": F.col("mid") + REACH * (F.col("high") - F.col("mid"))}
    return rows.groupBy("lang", "source").agg(*(F.max(F.when(F.col("measure") == m, x)).alias(f"{m}_{q}") for m in MEASURES for q, x in fences.items()))


def leaves_fence(measure: str) -> Column:
    count, size = (F.col(c) for c in MEASURES[measure])
    low, mid, high = (F.col(f"{measure}_{q}") for q in ("low", "mid", "high"))
    if measure == "word_length":
        noise = NOISE * mid / F.sqrt(F.greatest(size, F.lit(1)))
        return (F.col(measure) > high + noise) | (F.col(measure) < low - noise)
    return count > high * size + NOISE * F.sqrt(high * size + 1)


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the name of the first measure that leaves its fence, for every row.

    Null and empty texts have no words and fail the base rule; texts of any length are counted whole. Null languages and
    sources are a group like others. Repeated rows count as often as they come, and rows of one doc_id or none stay as they
    are. An empty table gives no rows. Columns beside doc_id, text, lang and source are not read, so none can clash.
    """
    measured = with_measures(materialise(measure(docs), "measures"))
    rows = measured.join(thresholds(sketches(measured)), ["lang", "source"])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 100 * MAX_REPEAT * F.col("n_words"))
    reason = F.when(failed, F.lit("base")).otherwise(F.coalesce(*(F.when(leaves_fence(m), F.lit(m)) for m in MEASURES)))
    return rows.select("doc_id", *COUNTS[:5], failed.alias("base_failed"), reason.isNull().alias("kept"), reason.alias("reason"))
