"""Usage, statuses and run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpuskiln.functions.text import estimate_tokens, strip_ws

COUNTERS = ("prompt_tokens", "completion_tokens", "total_tokens")


def fill_usage(calls: DataFrame) -> DataFrame:
    """calls (prompt, response, the counters, usage_source, ...): where the total isn't positive, estimates take their place."""
    missing = F.coalesce(F.col("total_tokens"), F.lit(0)) <= 0
    asked, told = estimate_tokens(F.col("prompt")), estimate_tokens(F.col("response"))
    return calls.withColumns(
        {
            "prompt_tokens": F.when(missing, asked).otherwise(F.col("prompt_tokens")),
            "completion_tokens": F.when(missing, told).otherwise(F.col("completion_tokens")),
            "total_tokens": F.when(missing, asked + told).otherwise(F.col("total_tokens")),
            "usage_source": F.when(missing, "estimated").otherwise(F.col("usage_source")),
        }
    )


def token_totals(calls: DataFrame) -> DataFrame:
    return calls.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS])


def usage_rows(calls: DataFrame) -> DataFrame:
    return calls.select(*COUNTERS, "call_type", "exercise_label", "usage_source")


def assemble_chunks(chunks: DataFrame, key: str = "call_id") -> DataFrame:
    """chunks (key, seq, content, usage): the contents in order, empty ones aside, without outer white space; the last usage that isn't null."""
    parts = F.array_sort(F.collect_list(F.when(F.coalesce(F.col("content"), F.lit("")) != "", F.struct("seq", "content"))))
    return chunks.groupBy(key).agg(strip_ws(F.array_join(F.transform(parts, lambda x: x["content"]), "")).alias("text"), F.max_by("usage", F.when(F.col("usage").isNotNull(), F.col("seq"))).alias("usage"))


def final_status(translated: Column, is_valid: Column, repair_fixed: Column) -> Column:
    """translated, is_valid, repair_fixed: booleans, null where a stage didn't run."""
    return (
        F.when(~F.coalesce(translated, F.lit(False)), F.when(translated.isNull(), "pending").otherwise("error"))
        .when(F.coalesce(is_valid, F.lit(False)) | F.coalesce(repair_fixed, F.lit(False)), "valid")
        .when(repair_fixed.isNotNull(), "repair_failed")
        .otherwise("translated")
    )


def broken(exercises: DataFrame) -> DataFrame:
    """What goes to repair: not valid, and not failed before it was compiled."""
    return exercises.where((~F.col("is_valid")) & (F.col("status") != "error"))


def status_summary(exercises: DataFrame) -> DataFrame:
    named = ("valid", "repair_failed", "error")
    counts = exercises.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in named])
    return counts.withColumn("other", F.col("total") - F.col("valid") - F.col("repair_failed") - F.col("error"))


def exercise_report(exercises: DataFrame, diagnostics: DataFrame, key: str = "ex_id") -> DataFrame:
    """exercises (key, label, status, repair_attempts) with the number of their errors and warnings, none included."""
    counts = diagnostics.groupBy(key).agg(F.count_if(F.col("severity") == "error").alias("num_errors"), F.count_if(F.col("severity") == "warning").alias("num_warnings"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return exercises.join(counts, key, "left").select(key, "label", "status", "repair_attempts", zero("num_errors"), zero("num_warnings"))


def conversion_counts(results: DataFrame) -> DataFrame:
    """results (ok): how many were written and how many failed."""
    return results.agg(F.count_if("ok").alias("written"), F.count_if(~F.col("ok")).alias("failed"))


def write_counted(rows: DataFrame, path: str, mode: str = "errorifexists", **counts: Column) -> dict:
    """Writes rows as parquet and returns the counts, aggregates of their columns, taken on the way: nothing is read twice."""
    seen = Observation()
    rows.observe(seen, *[c.alias(name) for name, c in counts.items()]).write.mode(mode).parquet(path)
    return seen.get


def conversion_aggregates(ok: Column) -> dict[str, Column]:
    """For ``write_counted`` of results: how many were written and how many failed."""
    return {"written": F.count_if(ok), "failed": F.count_if(~ok)}


def token_aggregates() -> dict[str, Column]:
    """For ``write_counted`` of calls: the totals of the counters."""
    return {c: F.coalesce(F.sum(c), F.lit(0)) for c in COUNTERS}


def write_report(calls: DataFrame, exercises: DataFrame, diagnostics: DataFrame, path: str, stamp: str) -> None:
    """Totals, calls and exercises as JSON under a folder named by the run's stamp."""
    for name, part in (("total", token_totals(calls)), ("calls", usage_rows(calls)), ("exercises", exercise_report(exercises, diagnostics))):
        part.write.option("ignoreNullFields", False).json(f"{path}/token_usage_{stamp}/{name}")
