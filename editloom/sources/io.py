"""Files: JSON lines, gzipped JSON documents, sheets, configurations."""

from __future__ import annotations

import os
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import joined_commit

BAD = "_bad_line"


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str, strict: bool = False) -> DataFrame:
    """JSON lines; blank lines are no rows. Lines that are no JSON are dropped, or stop the job if strict."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    made = F.from_json("value", f"{schema}, {BAD} string", {"columnNameOfCorruptRecord": BAD})
    return read_lines(spark, path).select(made.alias("r")).filter(F.col(f"r.{BAD}").isNull()).select("r.*").drop(BAD)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Undecoded lines (value), so that sampling comes before decoding."""
    return spark.read.text(path).filter("length(trim(value)) > 0")


def decode(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    return lines.select(F.from_json(column, schema).alias("r")).select("r.*")


def normalise(rows: DataFrame) -> DataFrame:
    """commit as text, whether the file has an array or text."""
    return rows.withColumn("commit", joined_commit(F.col("commit"))) if "commit" in rows.columns and dict(rows.dtypes)["commit"] == "string" else rows.withColumn("commit", F.concat_ws(",", "commit"))


def with_row_id(rows: DataFrame, *keys: str) -> DataFrame:
    """row_id from the content: the same for any partitioning. Equal rows share it."""
    return rows.withColumn("row_id", F.xxhash64(*(keys or rows.columns)))


def write_jsonl(rows: DataFrame, path: str, mode: str = "overwrite", ascii_only: bool = False) -> None:
    if not ascii_only:
        rows.write.mode(mode).json(path)
        return
    line = F.to_json(F.struct(*rows.columns))
    rows.select(escape(line).alias("value")).write.mode(mode).text(path)


def escape(line: Column) -> Column:
    r"""Everything beyond ASCII as \uXXXX, in pairs beyond 16 bits."""
    beyond, within = r"[^\x00-\x7f]", r"[\x00-\x7f]"
    # cut where runs within and beyond ASCII meet, so that the work grows as the text; most lines have nothing to escape
    runs = F.split(line, f"(?<={within})(?={beyond})|(?<={beyond})(?={within})")
    units = lambda c: F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", r"\\u$1")
    return F.when(line.rlike(beyond), F.array_join(F.transform(runs, lambda c: F.when(F.ascii(c) < 128, c).otherwise(units(c))), "")).otherwise(line)


def project(rows: DataFrame, fields: list[str]) -> tuple[DataFrame, list[str]]:
    """The wanted fields that are there, in the wanted order, and the names of those that are not."""
    return rows.select(*(f for f in fields if f in rows.columns)), [f for f in fields if f not in rows.columns]


def split_rejects(rows: DataFrame, valid: Column, reject_path: str | None = None) -> DataFrame:
    """Rows that are valid; the others go to a quarantine folder if one is given."""
    ok = F.coalesce(valid, F.lit(False))
    if reject_path is not None:
        rows.filter(~ok).write.mode("append").json(reject_path)
    return rows.filter(ok)


def read_results(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Result files, plain or gzipped, anywhere below `path`, each one JSON document; files that cannot be read, or have no
    results, are no rows.

    With the directory a file is in and that directory's parent.
    """
    # the whole file is the record; what is no gzip or no JSON must not stop the others
    rows = (
        spark.read.schema(f"{schema}, {BAD} string").option("columnNameOfCorruptRecord", BAD).option("multiLine", True).option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.results.json*").option("ignoreCorruptFiles", True).json(path)
    )
    parts = F.split(F.regexp_replace(F.col("_metadata.file_path"), "/+", "/"), "/")
    rows = rows.select("*", F.element_at(parts, -2).alias("name"), F.coalesce(F.try_element_at(parts, F.lit(-3)), F.lit("")).alias("directory"), F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("folder"))
    return rows.filter(F.col(BAD).isNull() & F.col("results").isNotNull()).drop(BAD)


def leaf_folders(rows: DataFrame) -> DataFrame:
    """Rows of folders without sub-folders that hold results; a given folder counts if it is one."""
    folders = rows.select("folder").distinct()
    parents = folders.select(F.explode(F.transform(F.sequence(F.lit(2), F.size(F.split("folder", "/"))), lambda n: F.array_join(F.slice(F.split("folder", "/"), F.lit(1), n - 1), "/"))).alias("folder")).distinct()
    return rows.join(folders.join(parents, "folder", "left_anti"), "folder", "left_semi")


def last_parts(path: Column) -> tuple[Column, Column]:
    """(directory, name): the last two components, whether or not the path ends in a slash."""
    parts = F.split(F.regexp_replace(path, "/+$", ""), "/")
    return F.coalesce(F.try_element_at(parts, F.lit(-2)), F.lit("")), F.element_at(parts, -1)


def write_completions(rows: DataFrame, folder: str) -> DataFrame:
    """One gzipped JSON document a problem and kind, `<full_name>_<instr_kind>.json.gz` in the folder, replaced as a whole;
    returns full_name, instr_kind and file. A row is one document, so no task holds more than its own."""
    import gzip

    import pyarrow.fs as pafs

    line = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})

    def run(frames):
        fs, base = pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{os.path.abspath(folder)}")
        fs.create_dir(base, recursive=True)
        for f in frames:
            names = []
            for full_name, kind, text in zip(f["full_name"], f["instr_kind"], f["line"], strict=True):
                name = f"{base}/{full_name}_{kind}.json.gz"
                temp = f"{base}/.{uuid.uuid4().hex}"
                with fs.open_output_stream(temp, compression=None) as out:
                    out.write(gzip.compress(text.encode(), mtime=0))
                fs.move(temp, name)
                names.append(name)
            yield f[["full_name", "instr_kind"]].assign(file=names)

    made = rows.select("full_name", "instr_kind", line.alias("line")).mapInPandas(run, "full_name string, instr_kind string, file string")
    return rows.sparkSession.createDataFrame(made.collect(), "full_name string, instr_kind string, file string")


def append_sheet(rows: DataFrame, path: str, kind: str = "parquet") -> None:
    """Add rows to a sheet: a table in a folder, or with kind `file` one CSV file with one header, for small results."""
    if kind == "file":
        new = not os.path.exists(path)
        rows.toPandas().to_csv(path, mode="a", header=new, index=False)
        return
    rows.write.mode("append").format(kind).options(**({"header": True} if kind == "csv" else {})).save(path)


def to_csv(rows: DataFrame, missing: str = "NA") -> str:
    """A small result as text with a header."""
    return rows.toPandas().to_csv(index=False, na_rep=missing)


def read_config(path: str, needed: tuple[str, ...] = ()) -> dict[str, Any]:
    import yaml

    with open(path) as f:
        found = yaml.safe_load(f) or {}
    missing = [k for k in needed if k not in found]
    if missing:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return found


def api_key(name: str) -> str:
    """Keys come from the environment, never from files of the repository."""
    key = os.environ.get(name)
    if not key:
        raise KeyError(f"set {name}")
    return key
