"""The operators as stages of a corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

Filtering stages return the columns of `docs`, whatever they are, and only read doc_id and text. Null texts count as empty
and stay null. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from . import bpe, decontam, mil, pii, simhash
from .common import keep_rows, map_arrow, materialise, table, tokenizer_file

CUT = 0.7
SIMILARITY = 0.8


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on these documents' labels, scores at CUT or above."""
    model = spark.sparkContext.broadcast(mil.fit(docs, table(spark, sf_dir, "labels")))
    return keep_rows(docs, lambda texts: (model.value.score(texts) >= CUT).tolist() if texts else [])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one of least doc_id. Rows of one doc_id are one document, of which one row
    stays; rows without a doc_id cannot be named and stay."""
    found = materialise(simhash.similar(docs, similarity=SIMILARITY), "groups")
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    twice = materialise(found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "twice")
    # one plan at every size: the ids to drop grow with the documents and are never broadcast
    left = docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti")
    if twice.limit(1).count():
        left = left.join(twice, "doc_id", "left_anti").unionByName(left.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    return left.select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item to SIMILARITY of its shingles or more."""
    for index in decontam.indexes(table(spark, sf_dir, "benchmark"), SIMILARITY):
        shipped = spark.sparkContext.broadcast(index)
        docs = keep_rows(docs, lambda texts, shipped=shipped: [not x for x in shipped.value.search(texts)])
    return docs


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in angle brackets; n_chars, if there, follows."""

    def block(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        k = batch.schema.get_field_index("text")
        kind = batch.schema.field(k).type
        new = [None if t is None else pii.redact(t, pii.find(t)) for t in batch.column(k).to_pylist()]
        columns = list(batch.columns)
        columns[k] = pa.array(new, kind)
        n = batch.schema.get_field_index("n_chars")
        if n >= 0 and pa.types.is_integer(batch.schema.field(n).type):
            old = batch.column(n).to_pylist()
            columns[n] = pa.array([o if o is None or t is None else len(t) for o, t in zip(old, new, strict=True)], batch.schema.field(n).type)
        yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_arrow(docs, block, docs.schema)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents but for the text, with n_tokens and token_ids. Every text is decoded again; a text that
    does not come back stops the job."""
    path, pattern = tokenizer_file("byte_bpe_50k.tiktoken"), bpe.default_pattern()
    rest = [c for c in docs.columns if c not in ("text", "n_tokens", "token_ids")]
    schema = StructType([*(docs.schema[c] for c in rest), StructField("n_tokens", LongType()), StructField("token_ids", ArrayType(IntegerType()))])

    def block(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        enc = bpe.encoder(path, pattern)
        texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
        ids = enc.encode(texts)
        for t, x in zip(texts, ids, strict=True):
            if enc.decode(x) != t.encode():
                raise ValueError("a text does not survive encoding and decoding")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32)))
        kept = [batch.column(batch.schema.get_field_index(c)) for c in rest]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(sizes), lists], [*rest, "n_tokens", "token_ids"])

    return map_arrow(docs, block, schema)
