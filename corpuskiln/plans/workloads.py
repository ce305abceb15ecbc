"""The three workloads from end to end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.functions.code import extract_code
from corpuskiln.functions.jsonx import EMPTY_OUTPUT, NOT_JSON, candidate_problem, check_candidate, fields_of, unreadable, with_problem
from corpuskiln.functions.prompts import repair_prompt, rewrite_prompt, translate_prompt
from corpuskiln.functions.text import file_stem
from corpuskiln.operators import attempts, diagnostics, outputs, records, reports, selection
from corpuskiln.operators.ledger import CallLedger
from corpuskiln.sources import exercises as source


def select_by_type(spark: SparkSession, path: str, code: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(core rows, matches per file, files that could not be parsed) of a tree of JSON files."""
    good, bad = source.good_and_bad(source.parse_documents(source.read_documents(spark, path, empty=True)))
    chosen = selection.filter_by_type(good, code)
    return selection.project_core(chosen), selection.matches_per_file(chosen), bad


def load_exercises(documents: DataFrame) -> DataFrame:
    """(file, content) to ex_id, file, ordinal, raw_json, label, problem, file_name."""
    found = source.parse_documents(documents, "exercises").where("error IS NULL").withColumn("odd", fields_of(unreadable(F.col("raw_json"))))
    parsed, odd = F.try_parse_json(F.col("raw_json")), F.col("odd")
    rows = found.select(F.concat_ws("#", "file", "ordinal").alias("ex_id"), "file", "ordinal", "raw_json", records.label(parsed, F.col("ordinal"), odd=odd).alias("label"), records.problem_text(parsed, odd).alias("problem"))
    return rows.withColumn("file_name", F.concat(file_stem(F.col("label")), F.lit(".lean")))


def diagnose(logs: DataFrame, sources: DataFrame) -> DataFrame:
    """Logs (ex_id, stdout, stderr) to diagnostics with their source lines."""
    output = logs.select("ex_id", diagnostics.joined_log(F.col("stdout"), F.col("stderr")).alias("output"))
    return diagnostics.with_source_context(diagnostics.parse_diagnostics(output), sources)


class CorpusRun:
    """The full run with the caller's model and compiler. ``keep(df, name)`` stores a stage and reads it back, so that no
    call is paid for twice when something is lost; with a ledger, not even by a task that is tried again or a run that is
    begun anew.

    What is kept holds each text once: an exercise as it was found, and what the model answered. Rounds keep ids and verdicts
    alone, and rewritten exercises are put together from the two where they are read, the result's ``exercises`` as well."""

    def __init__(self, model: Callable, compiler: Callable, keep: Callable[[DataFrame, str], DataFrame], prompts: dict[str, str], rewrites: int = 8, translations: int = 3, repairs: int = 5, ledger: CallLedger | None = None):
        self.respond = ledger.respond if ledger else attempts.respond
        self.model, self.compiler, self.keep, self.prompts = model, compiler, keep, prompts
        self.rewrites, self.translations, self.repairs = rewrites, translations, repairs

    def _stage(self, work: DataFrame, prompt: Column, result: Column, stage: str, limit: int, fault: Column | None = None, made: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> tuple[DataFrame, DataFrame]:
        """Rounds over work (ex_id, ...), of which made gives what prompts are about: (ex_id, result) of those accepted, and all
        calls. fault says what is wrong with a response; prompts find that of the last one in a column feedback. A failed call has
        no response and changes none."""

        calls = []

        def step(left: DataFrame, k: int) -> DataFrame:
            asked = made(work.withColumn("feedback", F.lit("")) if k == 1 else work.join(left, "ex_id"))  # left is all of work at first
            said = self.keep(self.respond(asked.select("ex_id", F.lit(k).alias("attempt"), prompt.alias("prompt")), self.model, stage), f"{stage}_{k}_calls")
            calls.append(said)
            told = F.lit(None).cast("string") if fault is None else F.when(F.col("error").isNull(), fault)
            out = said.select("ex_id", F.coalesce(result != "", F.lit(False)).alias("ok"), told.alias("told"))
            both = out.withColumn("feedback", F.lit("")) if k == 1 else left.join(out, "ex_id")
            return both.select("ex_id", F.coalesce("told", "feedback").alias("feedback"), "ok")

        attempts.run_rounds(work.select("ex_id", F.lit("").alias("feedback")), step, limit, lambda df, k: self.keep(df, f"{stage}_{k}"))
        every = calls[0]
        for c in calls[1:]:
            every = every.unionByName(c)
        return every.select("ex_id", result.alias("result")).where("result != ''"), every  # one is accepted once

    def __call__(self, documents: DataFrame) -> dict[str, DataFrame]:
        found = self.keep(load_exercises(documents).drop("problem"), "exercises")
        base = {k: F.lit(v) for k, v in self.prompts.items()}
        wrong = check_candidate(F.col("response"))
        wrong = F.when(wrong.isin(EMPTY_OUTPUT, NOT_JSON), F.concat(F.lit("Output parsing failed: "), wrong)).otherwise(wrong)
        rewritten, c1 = self._stage(found.select("ex_id", "raw_json"), rewrite_prompt(base["rewrite"], F.col("raw_json"), F.col("feedback")), candidate_problem(F.col("response")), "rewrite", self.rewrites, wrong)
        own = records.problem_text(F.try_parse_json(F.col("raw_json")), fields_of(unreadable(F.col("raw_json"))))

        def ready(rows: DataFrame) -> DataFrame:
            """Rows of found as rewritten. They are joined with others before: what has been through a helper is dealt anew."""
            both = rows.join(rewritten.withColumnRenamed("result", "rewritten"), "ex_id", "left")
            return both.withColumns({"problem": F.coalesce("rewritten", own), "raw_json": with_problem(F.col("raw_json"), F.col("rewritten"))}).drop("rewritten")

        coded, c2 = self._stage(found.select("ex_id", "raw_json"), translate_prompt(base["translate"], F.col("raw_json")), extract_code(F.col("response")), "translate", self.translations, made=ready)
        state = found.drop("raw_json", "label").join(coded.withColumnRenamed("result", "code"), "ex_id", "left")
        state = self.keep(state, "translated")
        checked = self._compile(state.where("code IS NOT NULL").select("ex_id", "file_name", "code"), "compile")
        calls, left, fixed = [c1, c2], checked.where("NOT is_valid"), checked.where("is_valid").select("ex_id", F.lit(0).alias("repair_attempts"), "code", F.lit(True).alias("is_valid"), "n_errors", "n_warnings")
        repaired = []
        for k in range(1, self.repairs + 1):
            if left.isEmpty():
                break
            prompt = repair_prompt(base["repair"], F.col("code"), F.col("errors"))
            said = self.keep(self.respond(left.select("ex_id", F.lit(k).alias("attempt"), prompt.alias("prompt")), self.model, "repair"), f"repair_{k}_calls")
            calls.append(said)
            fresh = left.drop("new").join(said.select("ex_id", extract_code(F.col("response")).alias("new")), "ex_id")
            usable = F.coalesce(F.col("new") != "", F.lit(False))
            tried = self._compile(fresh.where(usable).select("ex_id", "file_name", F.col("new").alias("code")), f"repair_{k}").withColumn("repair_attempts", F.lit(k))
            same = fresh.where(~usable).select(*[c for c in tried.columns if c in fresh.columns]).withColumn("repair_attempts", F.col("repair_attempts") if "repair_attempts" in fresh.columns else F.lit(0))
            now = self.keep(tried.unionByName(same, allowMissingColumns=True), f"repair_{k}_all")
            repaired.append(now.where("is_valid"))
            left = now.where("NOT is_valid")
        last = left if "repair_attempts" in left.columns else left.withColumn("repair_attempts", F.lit(0))
        outcome = fixed
        for part in [*repaired, last]:
            outcome = outcome.unionByName(part.select(*fixed.columns))
        final = state.drop("code").join(outcome, "ex_id", "left")
        status = F.when(F.col("is_valid").isNull(), "error").when(F.col("is_valid"), "valid").otherwise("repair_failed")
        final = self.keep(final.withColumns({"status": status, "repair_attempts": F.coalesce("repair_attempts", F.lit(0))}), "final")
        own_columns = ("ex_id", "file", "ordinal", "raw_json", "label", "problem", "file_name")
        outcome = final.drop("file", "ordinal", "file_name")
        exercises = ready(found.join(outcome, "ex_id")).select(*own_columns, *outcome.columns[1:])
        every = calls[0]
        for c in calls[1:]:
            every = every.unionByName(c)
        usage = every.join(found.select("ex_id", F.col("label").alias("exercise_label")), "ex_id").withColumnRenamed("stage", "call_type")
        files = outputs.resolve_collisions(outputs.with_code(final).select("file_name", F.col("code").alias("content"), F.struct("file", "ordinal").alias("seq")))
        return {"exercises": exercises, "calls": usage, "files": files, "summary": reports.status_summary(final), "totals": reports.token_totals(usage)}

    def _compile(self, files: DataFrame, name: str) -> DataFrame:
        """files (ex_id, file_name, code) with returncode, errors, is_valid and counts; every exercise gets its own verdict."""
        made = self.keep(attempts.compile_with(files.select("ex_id", "file_name", F.col("code").alias("content")), self.compiler), f"{name}_logs")
        found = diagnostics.parse_diagnostics(made)
        own = files.select(F.concat_ws("/", "ex_id", "file_name").alias("file"), F.col("code").alias("content"))
        placed = diagnostics.with_source_context(found.join(files.select("ex_id", "file_name"), "ex_id").withColumn("file", F.when(F.col("file") == F.col("file_name"), F.concat_ws("/", "ex_id", "file_name")).otherwise(F.col("file"))).drop("file_name"), own)
        slim = "array<struct<line:int,column:int,message:string,line_content:string>>"
        out = diagnostics.verdicts(files, made, placed)
        fields = F.transform(F.coalesce("errors", F.array().cast("array<struct<line:int,column:int,message:string,line_content:string,char_at_column:string>>")), lambda e: F.struct(e["line"].alias("line"), e["column"].alias("column"), e["message"].alias("message"), e["line_content"].alias("line_content")))
        return self.keep(out.select("ex_id", "file_name", "code", "returncode", fields.cast(slim).alias("errors"), "n_errors", "n_warnings", "is_valid"), f"{name}_verdicts")
