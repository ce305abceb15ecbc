"""Exercises as rows: raw JSON kept in order, and typed columns beside it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.functions.jsonx import ALIASES, MARKER_KEYS, PROBLEM_KEYS, STRICT_MARKERS
from corpuskiln.functions.text import file_stem, strip_ws


def has_key(raw_json: Column, *keys: str) -> Column:
    """Whether any of the keys is present, its value null or not."""
    return F.coalesce(F.arrays_overlap(F.json_object_keys(raw_json), F.array(*[F.lit(k) for k in keys])), F.lit(False))


def is_exercise(raw_json: Column, aliases: bool = True) -> Column:
    problem, markers = (PROBLEM_KEYS, MARKER_KEYS) if aliases else (("problem",), STRICT_MARKERS)
    return has_key(raw_json, *sorted(problem)) & has_key(raw_json, *sorted(markers))


def kind_of(parsed: Column, key: str) -> Column:
    """The type of a key's value: STRING, BIGINT, ARRAY<...>, VOID for a null; null if the key is absent."""
    return F.schema_of_variant(F.variant_get(parsed, f'$["{key}"]', "variant"))


def text_of(parsed: Column, key: str) -> Column:
    """A scalar as text; null if null or absent."""
    return F.try_variant_get(parsed, f'$["{key}"]', "string")


def truthy(parsed: Column, key: str, odd: Column | None = None) -> Column:
    """A value as text if it is neither empty, zero, false nor null. odd: fields_of of the rows that have no parsed."""
    if odd is not None:
        field = F.try_element_at(odd, F.lit(key))
        zero = field["kind"].isin("BIGINT", "DOUBLE") & (field["text"].try_cast("double") == 0)
        empty = (field["text"] == "") | zero | ((field["kind"] == "BOOLEAN") & (field["text"] == "false")) | field["text"].isin("[]", "{}")
        own = F.when(~F.coalesce(empty, F.lit(True)), F.when(field["kind"] == "BOOLEAN", F.initcap(field["text"])).otherwise(field["text"]))
        return F.when(odd.isNotNull(), own).otherwise(truthy(parsed, key))
    kind, text = kind_of(parsed, key), text_of(parsed, key)
    number = (kind == "BIGINT") | kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")
    falsy = (text == "") | (number & (F.try_to_number(text, F.lit("S999999999999999999D999999999")) == 0)) | ((kind == "BOOLEAN") & (text == "false")) | text.isin("[]", "{}")
    return F.when(~F.coalesce(falsy, F.lit(True)), F.when(kind == "BOOLEAN", F.initcap(text)).otherwise(text))


def normalised(parsed: Column, field: str) -> Column:
    """A field as variant: itself if present, else its first other name that is."""
    names = [field, *[other for other, to in ALIASES if to == field]]
    return F.coalesce(*[F.variant_get(parsed, f'$["{n}"]', "variant") for n in names])


def label(parsed: Column, sequence: Column, legacy: bool = False, odd: Column | None = None) -> Column:
    """The first of source_idx, 题目ID (unless legacy), index and the sequence number that isn't falsy."""
    keys = ("source_idx", "index") if legacy else ("source_idx", "题目ID", "index")
    return F.coalesce(*[truthy(parsed, k, odd) for k in keys], sequence.cast("string"))


def problem_text(parsed: Column, odd: Column | None = None) -> Column:
    return F.coalesce(truthy(parsed, "problem", odd), truthy(parsed, "题目内容", odd), F.lit(""))


def with_sequence(rows: DataFrame, group: str = "file", order: str = "ordinal") -> DataFrame:
    """1-based numbers within each file, in document order."""
    return rows.withColumn("sequence", F.row_number().over(Window.partitionBy(group).orderBy(order)))


#: Files sampled for the splitters of corpus_sequence.
SPLITTERS = 256


def corpus_sequence(rows: DataFrame, group: str = "file", order: str = "ordinal") -> DataFrame:
    """1-based numbers over the whole corpus: numbers within files, after the running total of the files before.

    Splitters from a sample of files cut the paths into ranges. Running totals within a range start at the total of the
    ranges before, so one task has one range's files, a row each, and one the ranges' totals. Any splitters give the same."""
    parts = F.split(group, "/")
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("__n"))
    sample = sorted(r[0] for r in sizes.select(parts).orderBy(F.xxhash64(group)).limit(SPLITTERS).collect())
    at = F.aggregate(F.array(*[F.array(*map(F.lit, x)) for x in sample]), F.lit(0), lambda n, x: n + (x <= parts).cast("int")) if sample else F.lit(0)
    ranged = sizes.withColumn("__range", at)
    earlier = lambda w: F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = ranged.groupBy("__range").agg(F.sum("__n").alias("__n"))
    totals = totals.select("__range", earlier(Window.orderBy("__range")).alias("__start"))
    before = ranged.withColumn("__in", earlier(Window.partitionBy("__range").orderBy(parts))).join(totals, "__range")
    numbered = with_sequence(rows, group, order).join(before.select(group, (F.col("__in") + F.col("__start")).alias("__before")), group)
    return numbered.withColumn("sequence", F.col("sequence") + F.col("__before")).drop("__before")


def numbered_name(index: Column, source_idx: Column, sequence: Column, extension: str = ".lean") -> Column:
    """problem_0001.lean by index (0 counts), else by source_idx, else by sequence; null for an index that is no number."""
    number = F.try_to_number(strip_ws(index), F.lit("S9999999999")).cast("long")
    by_index = F.when(number.isNotNull(), F.format_string(f"problem_%04d{extension}", number))
    by_source = F.concat(F.lit("problem_"), file_stem(source_idx), F.lit(extension))
    return F.when(index.isNotNull(), by_index).when(F.coalesce(source_idx, F.lit("")) != "", by_source).otherwise(F.format_string(f"problem_%04d{extension}", sequence.cast("long")))
