"""Helpers shared by the training-data operators.

Texts reach Python as Arrow batches and are handled in blocks of about a megabyte, so a worker's memory depends on
neither the partition nor the batch, but on the longest single text.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_CHARS = 1_000_000
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text with null as empty, and further columns; nothing else is read or can clash."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session, in local mode else one of our own."""
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: a cluster needs a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='editloom-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: the lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


_written: list[str] = []  # folders of this driver that may still be there


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def forget(df: DataFrame) -> None:
    """Delete the files of a table made by materialise() that nothing reads any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        delete(spark, str(spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent().toString()))


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what materialise() wrote within it. What is to stay is written elsewhere before."""
    before = len(_written)
    try:
        yield
    finally:
        while len(_written) > before:
            delete(spark, _written.pop())


def map_arrow(df: DataFrame, block: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow over slices of about BLOCK_CHARS characters of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield from block(part)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = BLOCK_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about `most` bytes; a longer text is a run of its own."""
    if not batch.num_rows:
        return
    k = batch.schema.get_field_index(column)
    if k < 0:
        yield batch
        return
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(k)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    yield batch.slice(start)


def raw(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file; the folder can be moved with EDITLOOM_TOKENIZERS."""
    own = os.environ.get("EDITLOOM_TOKENIZERS")
    if own:
        return os.path.join(own, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def keep_rows(docs: DataFrame, decide: Callable[[list[bytes]], list[bool]]) -> DataFrame:
    """The rows, with all their columns, whose text (null: empty) is to be kept; `decide` sees a block of texts at a time."""

    def block(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        mask = decide([x or b"" for x in raw(batch.column(batch.schema.get_field_index("text")))])
        yield batch.filter(pa.array(mask, pa.bool_()))

    return map_arrow(docs, block, docs.schema)
