"""One query per training-data operator, over whole tables, with the operator's production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontam, lm, mil, pii, rules, simhash, suffix, tokenfile, urls
from .common import table
from .sql import SQL as SQL


def op1_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.digests(table(spark, sf_dir, "documents"))


def op3_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


def op4_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def op5_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


def op8_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"))


def op9_passage_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mil.classify(docs, mil.fit(docs, table(spark, sf_dir, "labels")))


def op10_simhash_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_attention_scores, op2_token_files, op3_suffix_repeats, op4_adaptive_rules, op5_benchmark_containment, op6_byte_bpe, op7_personal_data, op8_url_templates, op9_passage_classifier, op10_simhash_trees)}
