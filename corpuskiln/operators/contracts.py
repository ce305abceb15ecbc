"""Rules that prompts impose on responses, as checks of a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions.prompts import COMMENT_FIELDS
from corpuskiln.functions.text import strip_ws

UNITS = ("Definition", "Hypothesis", "Goal")


def labelled_units(rows: DataFrame, key: str = "ex_id", text: str = "problem") -> DataFrame:
    """(key, nth, unit, body): parts of a text that begin with a label and a colon at the start of a line."""
    found = F.regexp_extract_all(F.concat(F.col(text), F.lit("\n")), F.lit(r"(?ms)^([A-Z][A-Za-z]*):(.*?)(?=^[A-Z][A-Za-z]*:|\z)"), F.lit(0))
    return rows.select(key, F.posexplode(found).alias("nth", "whole")).select(key, "nth", F.regexp_extract("whole", r"^([A-Za-z]+):", 1).alias("unit"), strip_ws(F.regexp_replace("whole", r"^[A-Za-z]+:", "")).alias("body"))


def unit_flags(rows: DataFrame, key: str = "ex_id", text: str = "problem") -> DataFrame:
    """(key, has_symbols, unknown_units, has_goal) of every row."""
    units = labelled_units(rows, key, text).groupBy(key).agg(F.count_if(~F.col("unit").isin(*UNITS)).alias("unknown_units"), F.bool_or(F.col("unit") == "Goal").alias("has_goal"))
    symbols = F.col(text).rlike(r"[∀-⋿←-⇿α-ωℕℝℤ]")
    return rows.select(key, symbols.alias("has_symbols")).join(units, key, "left").select(key, "has_symbols", F.coalesce("unknown_units", F.lit(0)).alias("unknown_units"), F.coalesce("has_goal", F.lit(False)).alias("has_goal"))


def parse_header(code: Column) -> dict[str, Column]:
    """The fields of a block comment at the head of a file; a field's text ends at the next field's name."""
    names = [*COMMENT_FIELDS, None]
    ends = [rf"\n{n}: " if n else r"\n-/" for n in names[1:]]
    return {n: F.regexp_extract(code, rf"(?s)^/-.*?\n{n}: ?(.*?){e}", 1) for n, e in zip(names, ends)}


def header_differences(code: Column, exercise: dict[str, Column]) -> Column:
    """The names of the fields whose text in the head comment isn't the exercise's, in their order; a field the exercise
    hasn't, or has as null, is empty there. White space around a text doesn't count. A field is also as it should be if its
    own text stands there between its name and the next field's, whatever names of fields that text has lines with."""
    told = parse_header(code)
    own = lambda k: F.coalesce(exercise[k].cast("string"), F.lit("")) if k in exercise else F.lit("")
    ends = [*[f"\n{n}: " for n in COMMENT_FIELDS[1:]], "\n-/"]
    there = {k: F.contains(code, F.concat(F.lit(f"\n{k}: "), own(k), F.lit(end))) for k, end in zip(COMMENT_FIELDS, ends)}
    return F.array_compact(F.array(*[F.when(~there[k] & (strip_ws(told[k]) != strip_ws(own(k))), k) for k in COMMENT_FIELDS]))


def code_flags(code: Column) -> dict[str, Column]:
    """Statements without a placeholder proof, and a missing library import."""
    statements = F.regexp_count(code, F.lit(r"(?m)^\s*(theorem|lemma)\b"))
    return {"statements": statements, "placeholders": F.regexp_count(code, F.lit(r"\bsorry\b")), "missing_import": ~code.rlike(r"(?m)^import Mathlib\b"), "unproved_shape": statements > F.regexp_count(code, F.lit(r"\bsorry\b"))}
