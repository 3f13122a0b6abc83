"""Jobs that go on where they stopped: what is in the sink is not done again, and nothing is in it twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery


def remaining(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `todo` whose keys are not in `done`."""
    return todo.join(done.select(*keys).distinct(), keys, "left_anti")


def run_available(spark: SparkSession, source: str, schema: str, step: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, fmt: str = "json", files_per_batch: int = 100) -> StreamingQuery:
    """Process all new files of a folder through `step` and append to the sink, in batches with a checkpoint each.

    A batch that failed half-way runs again with the same files and replaces its own folder, so its rows are there once.
    """

    def write(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.option("basePath", sink).parquet(sink).drop("batch")


def append_new(rows: DataFrame, sink: str, keys: list[str]) -> None:
    """Append the rows whose keys the sink does not have yet; of equal keys one row."""
    spark = rows.sparkSession
    rows = rows.dropDuplicates(keys)
    path = spark._jvm.org.apache.hadoop.fs.Path(sink)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        rows = remaining(rows, spark.read.parquet(sink), keys)
    rows.write.mode("append").parquet(sink)
