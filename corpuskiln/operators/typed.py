"""Exercises stored by type, so that a selection reads what it needs and no more."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.operators.selection import CORE_FIELDS, TYPES, project_core, types_of

#: Settings under which variants are written with their common fields as columns of their own.
SHREDDED = {"spark.sql.variant.writeShredding.enabled": "true", "spark.sql.variant.inferShreddingSchema": "true"}


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def flag(code: str) -> str:
    return f"is_{code}"


def write_typed(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """rows (file, ordinal, raw_json) as parquet: their core (see ``project_core``), a flag for each known type, raw_json, and
    the exercise as a variant whose common fields are columns of the file (null where Spark's JSON functions can't read it).

    Rows are sorted by their flags within each file, so whole row groups have one type and a filter on a flag skips the rest;
    a filter on a field of the variant reaches the file's columns as well."""
    flags = {flag(code): F.array_contains("__types", label) for code, label in TYPES.items()}
    core = project_core(rows.withColumn("__types", types_of(F.col("raw_json"))), keep=("file", "ordinal", "raw_json", "__types"))
    made = core.withColumns(flags).withColumn("exercise", F.try_parse_json("raw_json")).drop("__types")
    with _settings(rows.sparkSession, SHREDDED):
        made.sortWithinPartitions(*flags).write.mode(mode).parquet(path)


def select_typed(spark: SparkSession, path: str, code: str) -> DataFrame:
    """file, ordinal and core of the exercises of a type, as ``filter_by_type`` and ``project_core`` give them."""
    return spark.read.parquet(path).where(F.col(flag(code))).select("file", "ordinal", *CORE_FIELDS, "core_json")


def field(name: str, kind: str = "string") -> Column:
    """A field of the stored exercises, read as a column of its own where it is one."""
    return F.try_variant_get("exercise", f'$["{name}"]', kind)
