"""Column expressions on text that agree with Unicode-aware string methods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that count as white space: Unicode's, and four separators.
WHITE = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
LINE_END = r"\r\n|[\n\r\u000b\f\u001c-\u001e\u0085  ]"


def strip_ws(text: Column) -> Column:
    """Leading and trailing Unicode white space removed (trim knows only the space), in time linear in the text's length."""
    return F.btrim(text, F.lit(WHITE))


def is_blank(text: Column) -> Column:
    return strip_ws(F.coalesce(text, F.lit(""))) == ""


def split_lines(text: Column) -> Column:
    """Lines without their ends; a final line end starts no further line."""
    parts = F.split(text, LINE_END, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def char_at(text: Column, column: Column) -> Column:
    """The character at a 0-based place; empty outside the text."""
    return F.when((column >= 0) & (column < F.length(text)), F.substring(text, column + 1, F.lit(1))).otherwise("")


def file_stem(label: Column) -> Column:
    """Letters, digits, underscore, minus and full stop stay, others become underscores; an empty label is 'exercise'."""
    safe = F.regexp_replace(F.coalesce(label, F.lit("")), r"[^\p{L}\p{N}_\-.]", "_")
    return F.when(safe == "", "exercise").otherwise(safe)


def estimate_tokens(text: Column) -> Column:
    """A quarter of the code points, rounded up, at least 1; 0 for blank text."""
    stripped = strip_ws(F.coalesce(text, F.lit("")))
    return F.when(stripped == "", F.lit(0).cast("long")).otherwise(F.greatest(F.lit(1).cast("long"), F.ceil(F.length(stripped) / 4).cast("long")))


def run_stamp(moment: Column) -> Column:
    """yyyyMMdd_HHmmss in the session's zone, which should be UTC."""
    return F.date_format(moment, "yyyyMMdd_HHmmss")
