"""The same jobs over files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.operators import outputs, selection
from corpuskiln.sources.exercises import parse_documents


def new_documents(spark: SparkSession, path: str, names: str = "*.json") -> DataFrame:
    """A stream of (file, content), each JSON file once."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", names).load(path)
    return files.selectExpr("path AS file", "content")


def select_new(spark: SparkSession, path: str, code: str, out: str, checkpoint: str, names: str = "*.json"):
    """Exercises of a type from files not seen before, appended to out as parquet; ends when there are none left."""

    def batch(rows: DataFrame, _: int) -> None:
        selection.project_core(selection.filter_by_type(rows.where("error IS NULL"), code)).write.mode("append").parquet(out)

    parsed = parse_documents(new_documents(spark, path, names))
    return parsed.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def pending_batches(spark: SparkSession, path: str, done: DataFrame, name: str = "file_name") -> DataFrame:
    """A stream of parquet rows without those whose output exists."""
    return outputs.pending_only(spark.readStream.schema(spark.read.parquet(path).schema).parquet(path), done, name)


def _into(rows: DataFrame, out: str, checkpoint: str, mode: str):
    """Each batch to a folder of its own, so one that is repeated after a stop is there once."""

    def batch(found: DataFrame, k: int) -> None:
        found.write.mode("overwrite").parquet(f"{out}/batch={k}")

    return rows.writeStream.foreachBatch(batch).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_names(rows: DataFrame, out: str, checkpoint: str, name: str = "file_name", order: str = "seq"):
    """A stream's rows of names not seen before in it, in this run or an earlier one; of a batch's rows of one name the first
    in order. A name's state says that it is there; rows come to it in pieces, of which it keeps one row."""
    import pandas as pd

    def unseen(key, frames, state):
        if state.exists:
            return
        least = None
        for f in frames:
            both = f if least is None else pd.concat([least, f])
            least = both.nsmallest(1, order)
        state.update((True,))
        yield least

    kept = rows.groupBy(name).applyInPandasWithState(unseen, rows.schema, "seen boolean", "append", "NoTimeout")
    return _into(kept, out, checkpoint, "append")


def last_names(rows: DataFrame, out: str, checkpoint: str, name: str = "file_name", order: str = "seq"):
    """For each name that a batch has rows of, the last row so far in order, and how many there were: what is written later
    overwrites (see ``latest``)."""
    best = rows.groupBy(name).agg(F.max_by(F.struct(*rows.columns), F.col(order)).alias("row"), F.count(F.lit(1)).alias("same_name"))
    return _into(best.select("row.*", "same_name"), out, checkpoint, "update")


def latest(batches: DataFrame, name: str = "file_name") -> DataFrame:
    """Of what ``last_names`` wrote, each name's row of the last batch that has one."""
    return batches.groupBy(name).agg(F.max_by(F.struct(*batches.columns), F.col("batch")).alias("row")).select("row.*")
