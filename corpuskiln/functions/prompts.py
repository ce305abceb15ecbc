"""Prompts and comment blocks as column expressions. The instructions are parameters; only their arrangement is fixed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskiln.functions.jsonx import pretty_json

ONE_OBJECT = "Work on this one exercise alone. Answer with one JSON object; change no field but \"problem\", and give that as Definition / Hypothesis / Goal units."
FEEDBACK = "The answer before this one was rejected. Mend it by this feedback:"
ONLY_CODE = "Answer with code only, neither JSON nor prose."
ONLY_FILE = "Answer with the mended file only."
#: Fields of the comment block in their order, and the note for a failure without diagnostics.
COMMENT_FIELDS = ("index", "source_idx", "source", "题目类型", "预估难度", "problem", "proof", "direct_answer")
NO_ERRORS = "(no structured errors; returncode was non-zero)"
#: Headings inside prompts, and the frames of code and errors.
OBJECT_HEADING, RETRY_NOTE = "Input JSON object:", "[Retry] The previous output was invalid: "
CODE_FRAME, ERROR_FRAME = ("== Lean code ==\n```lean\n", "\n```"), "== Compiler errors ==\n"


def rewrite_prompt(base: Column, raw_json: Column, feedback: Column | None = None, instruction: str = ONE_OBJECT) -> Column:
    told = F.lit("") if feedback is None else F.when(F.coalesce(feedback, F.lit("")) != "", F.concat(F.lit(f"\n\n{FEEDBACK}\n"), feedback, F.lit("\n"))).otherwise("")
    return F.concat(base, F.lit(f"\n\n{instruction}"), told, F.lit(f"\n\n{OBJECT_HEADING}\n"), pretty_json(raw_json))


def translate_prompt(base: Column, raw_json: Column, style: str = "plain", last_error: Column | None = None) -> Column:
    """style 'plain': instruction and object; 'headed': a heading between them, and a note on a retry."""
    if style == "plain":
        return F.concat(base, F.lit("\n\n"), pretty_json(raw_json))
    note = F.lit("") if last_error is None else F.when(F.coalesce(last_error, F.lit("")) != "", F.concat(F.lit(f"\n\n{RETRY_NOTE}"), last_error, F.lit(f"\n{ONLY_CODE}"))).otherwise("")
    return F.concat(base, F.lit(f"\n\n{OBJECT_HEADING}\n"), pretty_json(raw_json), note)


def render_errors(errors: Column) -> Column:
    """errors: array of struct(line, column, message, line_content). A line each, and one for the source line if there is one."""
    one = F.transform(
        errors,
        lambda e: F.concat(
            F.lit("  line "), e["line"].cast("string"), F.lit(":"), e["column"].cast("string"), F.lit(": "), e["message"],
            F.when(e["line_content"] != "", F.concat(F.lit("\n    | "), e["line_content"])).otherwise(""),
        ),
    )
    return F.array_join(one, "\n")


def repair_prompt(base: Column, code: Column, errors: Column, instruction: str = ONLY_FILE) -> Column:
    text = F.coalesce(render_errors(errors), F.lit(""))
    return F.concat(base, F.lit(f"\n\n{CODE_FRAME[0]}"), code, F.lit(f"{CODE_FRAME[1]}\n\n{ERROR_FRAME}"), F.when(text == "", NO_ERRORS).otherwise(text), F.lit(f"\n\n{instruction}"))


def header_comment(fields: dict[str, Column]) -> Column:
    """A block comment with a line for each field; missing ones are empty."""
    lines = [F.concat(F.lit(f"{k}: "), F.coalesce(fields[k].cast("string"), F.lit("")) if k in fields else F.lit("")) for k in COMMENT_FIELDS]
    return F.concat_ws("\n", F.lit("/-"), *lines, F.lit("-/"))
