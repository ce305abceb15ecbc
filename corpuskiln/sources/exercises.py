"""Trees of JSON files in, result tables and files out."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.functions import jsonx
from corpuskiln.sources.files import export_files, finish_exports, read_exported  # noqa: F401  part of the sources


def read_documents(spark: SparkSession, path: str, empty: bool = False) -> DataFrame:
    """(file, content) of every ``*.json`` under path. Names that begin with ``_`` or ``.`` are skipped, as Spark does.

    Spark's readers pass over empty files as well. With empty they are rows without content, to be quarantined: the list of
    files that Spark has made is compared with those it reads, which costs the driver a text a file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(path)
    rows = files.select(F.col("path").alias("file"), "content")
    if not empty:
        return rows
    listed = spark.createDataFrame([(unquote(f.partition(":")[2]).lstrip("/"),) for f in files.inputFiles()], "place string")
    there = files.select(F.regexp_replace("path", "^[^:]*:/*", "").alias("place"), "path")
    lost = listed.join(there, "place", "left_anti")
    scheme = files.inputFiles()[0].partition(":")[0] if files.inputFiles() else "file"
    return rows.unionByName(lost.select(F.concat(F.lit(f"{scheme}:/" if scheme == "file" else f"{scheme}://"), "place").alias("file"), F.lit(None).cast("binary").alias("content")))


def read_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """(file, raw_json) of files with one object a line, which can be split."""
    return spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("raw_json")).where("raw_json != ''")


def rows_in(content: bytes, what: str) -> tuple[list[str], str | None]:
    """(rows as JSON texts, error) of a document; see parse_documents."""
    value, error = jsonx.loads_bytes(content)
    if error:
        return [], error
    if what == "rows":
        found = jsonx.rows_of(value)
    else:
        found = [jsonx.with_canonical(x) if what == "exercises" else x for x in jsonx.exercises_in(value, what == "exercises")]
    try:
        return [jsonx.dumps(x) for x in found], None
    except RecursionError as e:  # nested deeper than can be written
        return [], f"{type(e).__name__}: {e}"


def parse_documents(documents: DataFrame, what: str = "rows") -> DataFrame:
    """(file, content) to (file, ordinal, raw_json, error): a file that can't be parsed gives one row with its error.

    what: 'rows' (a list's items or the one object), 'exercises' (at any depth, fields normalised) or 'strict' (at any
    depth, by canonical names alone, unchanged).
    """
    import pyarrow as pa

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                file, content = b.column(0)[k].as_py(), b.column(1)[k].as_py()
                rows, error = rows_in(content.encode() if isinstance(content, str) else content or b"", what)
                rows = [None] if error else rows
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([file] * len(rows), pa.string()), pa.array(range(1, len(rows) + 1), pa.int64()), pa.array(rows, pa.string()), pa.array([error] * len(rows), pa.string())], ["file", "ordinal", "raw_json", "error"])

    return documents.select("file", "content").mapInArrow(run, "file string, ordinal long, raw_json string, error string")


def good_and_bad(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    return parsed.where("error IS NULL").drop("error"), parsed.where("error IS NOT NULL").select("file", "error")


def in_file_order(rows: DataFrame) -> DataFrame:
    """By the parts of the path, then by place. Only for results that are read in order."""
    return rows.orderBy(F.split("file", "/"), "ordinal")


def write_results(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object a line; nulls stay."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
