"""What gets written: names, collisions, what is done already, and results put back into their documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.sources.generations import Generations


def with_code(rows: DataFrame, code: str = "code") -> DataFrame:
    return rows.where(F.length(code) > 0)


def resolve_collisions(rows: DataFrame, keep: str = "last", name: str = "file_name", order: str = "seq") -> DataFrame:
    """One row for each name: the last in order (later ones overwrite) or the first (what is there stays)."""
    by = F.max_by if keep == "last" else F.min_by
    packed = rows.groupBy(name).agg(by(F.struct(*rows.columns), F.col(order)).alias("__row"))
    return packed.select("__row.*")


def pending_only(rows: DataFrame, done: DataFrame, name: str = "file_name", overwrite: bool = False) -> DataFrame:
    return rows if overwrite else rows.join(done.select(name).distinct(), name, "left_anti")


def with_output(rows: DataFrame, files: DataFrame, name: str = "file_name") -> tuple[DataFrame, DataFrame]:
    """Rows that have an output file, and the ones that are skipped."""
    names = files.select(name).distinct()
    return rows.join(names, name, "left_semi"), rows.join(names, name, "left_anti")


def write_back(documents: DataFrame, rewritten: DataFrame, aliases: bool = True) -> DataFrame:
    """documents (file, content) with the problems of rewritten (file, ordinal, problem) put in where the exercises stand;
    everything else as it was: (file, content, n_rewritten, error). A document that can't be parsed, or is null, stays as it
    is, and error says why; so does one without changes, byte for byte."""
    import pyarrow as pa

    from corpuskiln.functions import jsonx

    new = rewritten.groupBy("file").agg(F.collect_list(F.struct("ordinal", "problem")).alias("changes"))

    def run(batches):
        for b in batches:
            for at in range(b.num_rows):  # one document's objects at a time
                file, content, changes = [c[at].as_py() for c in b.columns]
                by = {c["ordinal"]: c["problem"] for c in changes or []}
                document, error = jsonx.parsed(content or "")
                n = 0
                for k, exercise in enumerate(jsonx.exercises_in(document, aliases), 1):
                    if k in by:
                        exercise["problem"] = by[k]
                        n += 1
                row = [file, jsonx.dumps(document) if n else content, n, error]
                yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(row, (b.schema.field(0).type, pa.string(), pa.int64(), pa.string()))], ["file", "content", "n_rewritten", "error"])

    return documents.join(new, "file", "left").select("file", F.col("content").cast("string"), "changes").mapInArrow(run, "file string, content string, n_rewritten long, error string")


def write_back_changes(store: Generations, rewritten: DataFrame, aliases: bool = True) -> str:
    """As ``write_back``, into a store of documents: reads those that rewritten names, commits those that it changes, and
    leaves all others as they lie. Returns the generation."""
    named = store.documents().join(rewritten.select("file").distinct(), "file", "left_semi")
    return store.commit(write_back(named, rewritten, aliases).where("n_rewritten > 0").select("file", "content"))


def before_and_after(before: DataFrame, after: DataFrame, key: str = "ex_id") -> DataFrame:
    """(key, problem) of both: the two side by side, and whether they differ; what has no result keeps its text."""
    joined = before.join(after.select(key, F.col("problem").alias("problem_after")), key, "left")
    return joined.select(key, F.col("problem").alias("problem_before"), F.coalesce("problem_after", "problem").alias("problem_after")).withColumn("changed", F.col("problem_before") != F.col("problem_after"))


def ranked_names(rows: DataFrame, name: str = "file_name", order: str = "seq") -> DataFrame:
    """Adds how many rows share the name and which of them this is."""
    by = Window.partitionBy(name)
    return rows.withColumns({"same_name": F.count(F.lit(1)).over(by), "nth": F.row_number().over(by.orderBy(order))})
