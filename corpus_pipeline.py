"""From raw documents to token ids: good quality, no near copies, no benchmark items, no personal data, encoded.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from editloom.llm import stages
from editloom.llm.common import delete, new_folder, table, temporary

STAGES = [
    ("quality classifier", stages.good_quality),
    ("SimHash near-dedup", stages.without_near_copies),
    ("benchmark decontamination", stages.without_benchmark),
    ("PII", stages.without_personal_data),
    ("byte-level BPE", stages.encoded),
]

#: A learned score, connected components and a tokenizer are beyond SQL; tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage writes for itself, and its predecessor's rows, are deleted as soon as its own
    are written."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = new_folder(spark, name.lower().replace(" ", "-"))
        with temporary(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(folder)
        if last is not None:
            delete(spark, last)
        docs, last = spark.read.schema(made.schema).parquet(folder), folder
    return docs
