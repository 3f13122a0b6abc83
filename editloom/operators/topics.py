"""Topics of documents and samples balanced over them.

A non-parametric topic model has no counterpart in Spark; an online LDA with more topics than needed stands for it, of which
those that lead no document fall away. Its topics are alike in kind, not equal. All that follows from a topic per row is exact.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import instruction_words
from ..functions.tokens import ENGLISH_STOP_WORDS
from ..sources import scratch
from .sampling import balanced_sample
from .stats import filter_by_diff


def dominant(vector: Column) -> Column:
    """Place of the largest value, the first of equals; -1 for an empty, null or all-zero vector."""
    return F.when(F.coalesce(F.size(vector), F.lit(0)) <= 0, -1).when(F.array_max(vector) == 0, -1).otherwise(F.array_position(vector, F.array_max(vector)) - 1).cast("int")


def topic_words(text: Column, stop=ENGLISH_STOP_WORDS) -> Column:
    return F.filter(instruction_words(text), lambda w: w.rlike(r"(?U)^\p{L}+$") & ~w.isin(*sorted(stop)))


def fingerprint(docs: DataFrame) -> str:
    """Of the rows' content, whatever their order."""
    n, total = docs.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64(*docs.columns).cast("decimal(38,0)")), F.lit(0))).first()
    return f"{n}-{abs(int(total)):x}"


def fit(docs: DataFrame, tokens: str, k: int = 20, seed: int = 42, iterations: int = 10, cache: str | None = None, refit: bool = False) -> PipelineModel:
    """With a cache folder, a model of the same documents and settings is loaded instead of fitted. Every iteration goes
    through all word counts, so these are kept on the executors' disks meanwhile."""
    path = os.path.join(cache, f"{fingerprint(docs.select(tokens))}-{k}-{seed}-{iterations}") if cache else None
    if path and not refit and _exists(docs.sparkSession, path):
        return PipelineModel.load(path)
    words = CountVectorizer(inputCol=tokens, outputCol="bag_").fit(docs.select(tokens))
    bags = words.transform(docs.select(tokens)).select("bag_").persist(StorageLevel.DISK_ONLY)
    try:
        model = PipelineModel([words, LDA(k=k, seed=seed, maxIter=iterations, optimizer="online", featuresCol="bag_", topicDistributionCol="mixture_").fit(bags)])
    finally:
        bags.unpersist()
    if path:
        model.write().overwrite().save(path)
    return model


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def assign(docs: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds `topic`; -1 for documents without known words."""
    return model.transform(docs).withColumn("topic", dominant(vector_to_array("mixture_"))).drop("bag_", "mixture_")


def counts(rows: DataFrame, topic: str = "topic") -> DataFrame:
    return rows.groupBy(F.col(topic).alias("topic")).agg(F.count("*").alias("n"))


def top_topics(rows: DataFrame, topic: str = "topic", n: int = 20) -> DataFrame:
    return counts(rows, topic).orderBy(F.desc("n"), "topic").limit(n)


def diversity_filter(rows: DataFrame, text: Column, row_id: str, seed: int = 42, max_lines: int = 70, max_hunks: int = 7, max_total: int | None = 10_000, max_per_topic: int | None = None, k: int = 20, cache: str | None = None, carry: Sequence[str] | None = None, **columns) -> DataFrame:
    """Filter by size of change, then sample evenly over topics. The rows have the columns `carry`, else all.

    Diffs and words are computed once and kept on the executors' disks, in the partitions and the order they have, on which
    the model's draws depend. Each row's topic is found once and written to the scratch folder with the columns carried.
    """
    carried = list(dict.fromkeys((row_id, *(rows.columns if carry is None else carry))))
    kept = filter_by_diff(rows, max_lines=max_lines, max_hunks=max_hunks, **columns).withColumn("words_", topic_words(text)).select(*carried, "words_").persist(StorageLevel.DISK_ONLY)
    path = scratch.folder(rows.sparkSession, "topics")
    try:
        assign(kept, fit(kept, "words_", k, seed, cache=cache)).drop("words_").write.parquet(path)
        found = rows.sparkSession.read.schema(kept.drop("words_").withColumn("topic", F.lit(0)).schema).parquet(path)
    finally:
        kept.unpersist()
    return balanced_sample(found, "topic", row_id, seed, max_total, max_per_topic).select(*(rows.columns if carry is None else carry))
