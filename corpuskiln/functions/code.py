"""Code out of free-form responses, and a look at whether it is code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskiln.functions.text import is_blank, strip_ws

FENCE = "```"
#: Info words of a fence that are dropped, and words of which accepted code holds one as a substring.
INFO_WORDS = ("lean", "lean4", "")
#: Fixed value: the one info word of fenced blocks that are joined.
BLOCK_WORD = "lean"
CODE_MARKERS = ("import", "theorem", "def", "lemma", "variable", "section", "namespace", "sorry", "noncomputable", "open")


def outer_code(text: Column) -> Column:
    """What stands between the first and the last fence, or all of it; null for a blank response."""
    whole = strip_ws(F.coalesce(text, F.lit("")))
    first = F.instr(whole, FENCE)
    last = F.length(whole) - F.instr(F.reverse(whole), FENCE) - 1  # place of the last fence, from 1
    inner = strip_ws(F.substring(whole, first + 3, last - first - 3))
    newline = F.instr(inner, "\n")
    info = F.lower(strip_ws(F.substring(inner, F.lit(1), newline - 1)))
    body = F.when((newline > 0) & info.isin(*INFO_WORDS), F.substring(inner, newline + 1, F.length(inner))).otherwise(inner)
    return F.when(whole == "", None).when((first > 0) & (last > first), strip_ws(body)).otherwise(whole)


def block_code(text: Column) -> Column:
    """All fenced blocks (bare or marked 'lean'), blank ones dropped, joined by a blank line; without a block, all of it."""
    whole = strip_ws(F.coalesce(text, F.lit("")))
    blocks = F.regexp_extract_all(whole, F.lit(rf"(?s){FENCE}(?:{BLOCK_WORD})?\s*\n(.*?){FENCE}"), F.lit(1))
    kept = F.filter(F.transform(blocks, strip_ws), lambda b: b != "")
    return F.when(whole == "", None).when(F.size(blocks) > 0, F.array_join(kept, "\n\n")).otherwise(whole)


def extract_code(text: Column, mode: str = "outer") -> Column:
    return {"outer": outer_code, "blocks": block_code}[mode](text)


#: Fixed values.
NO_OUTPUT, LOOKS_LIKE_JSON, NO_KEYWORD = "Output is empty.", "Output looks like JSON, not Lean code.", "Output does not contain any recognizable Lean keywords."


def check_code(text: Column) -> Column:
    """What is wrong with a piece of code, or an empty text."""
    start = F.substring(strip_ws(text), 1, 1)
    known = F.exists(F.array(*[F.lit(m) for m in CODE_MARKERS]), lambda m: F.instr(text, m) > 0)
    return F.when(text.isNull() | is_blank(text), NO_OUTPUT).when(start.isin("{", "["), LOOKS_LIKE_JSON).when(~known, NO_KEYWORD).otherwise("")
