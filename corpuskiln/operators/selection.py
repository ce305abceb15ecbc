"""Exercises by type, projected to their core."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions.jsonx import fields_of, texts_at, unreadable
from corpuskiln.functions.prompts import COMMENT_FIELDS
from corpuskiln.functions.text import strip_ws
from corpuskiln.operators.records import has_key, kind_of, text_of

#: A type's code and its label in the data.
TYPES = {
    "proof_statement": "证明题",
    "calculation": "计算题",
    "fill_blank": "填空题",
    "multiple_choice": "选择题",
    "short_answer": "简答题",
    "application": "应用题",
}
TYPE_KEY = "题目类型"
#: The core fields in their order are those of the comment block.
CORE_FIELDS = COMMENT_FIELDS


def type_label(code: Column) -> Column:
    """The label of a code; null for an unknown one."""
    return F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair])[code]


def types_of(raw_json: Column) -> Column:
    """The types of an exercise, a text or a list of texts, without the white space around them; other values are none."""
    value = F.variant_get(F.try_parse_json(raw_json), f"$.{TYPE_KEY}", "variant")
    items = F.coalesce(F.try_variant_get(F.try_parse_json(raw_json), f"$.{TYPE_KEY}", "array<variant>"), F.array(value))
    texts = F.transform(items, lambda x: F.when(F.schema_of_variant(x) == "STRING", strip_ws(F.try_variant_get(x, "$", "string"))))
    return F.coalesce(texts_at(unreadable(raw_json), F.lit(TYPE_KEY)), F.array_compact(F.coalesce(texts, F.array().cast("array<string>"))))


def has_type(raw_json: Column, target: Column | str) -> Column:
    """Whether the type, a text or a list, is the target or holds it, white space around it aside."""
    return F.array_contains(types_of(raw_json), F.lit(target) if isinstance(target, str) else target)


def matches_by_type(rows: DataFrame) -> DataFrame:
    """(type_label, matches) of the known types; each row is parsed once, whatever number of types is asked for."""
    known = F.array_intersect(types_of(F.col("raw_json")), F.array(*map(F.lit, TYPES.values())))  # distinct
    return rows.select(F.explode(known).alias("type_label")).groupBy("type_label").agg(F.count(F.lit(1)).alias("matches"))


def filter_by_type(rows: DataFrame, code: str) -> DataFrame:
    return rows.where(has_type(F.col("raw_json"), TYPES[code]))


def project_core(rows: DataFrame, keep: tuple[str, ...] = ("file", "ordinal")) -> DataFrame:
    """The core fields as text, and core_json, the object of them with each value's own type, numbers digit by digit.

    A missing field is empty, a null one null; a problem_finally that isn't blank is the problem. Rows with longer numbers,
    deeper nesting or longer texts than Spark's JSON functions take are read by a helper, with the same results."""
    rows = rows.withColumn("__odd", fields_of(unreadable(F.col("raw_json"))))
    parsed, is_odd = F.try_parse_json(F.col("raw_json")), F.col("__odd").isNotNull()
    odd = lambda k, part: F.try_element_at("__odd", F.lit(k))[part]
    final = F.when(F.when(is_odd, odd("problem_finally", "kind")).otherwise(kind_of(parsed, "problem_finally")) == "STRING", strip_ws(F.when(is_odd, odd("problem_finally", "text")).otherwise(text_of(parsed, "problem_finally"))))
    there = {k: F.when(is_odd, F.map_contains_key("__odd", k)).otherwise(has_key(F.col("raw_json"), k)) for k in CORE_FIELDS}
    string = {k: kind_of(parsed, k) == "STRING" for k in CORE_FIELDS}
    other = {k: F.get_json_object("raw_json", f"$['{k}']") for k in CORE_FIELDS}  # numbers as they stand, lists and objects as JSON
    typed = {k: F.when(string[k], F.to_json(F.variant_get(parsed, f'$["{k}"]', "variant"))).otherwise(F.coalesce(other[k], F.lit("null"))) for k in CORE_FIELDS}
    text = {k: F.when(there[k], F.when(string[k], text_of(parsed, k)).otherwise(other[k])).otherwise("") for k in CORE_FIELDS}
    typed = {k: F.when(there[k], typed[k]).otherwise('""') for k in CORE_FIELDS}
    text = {k: F.when(is_odd & there[k], odd(k, "text")).otherwise(c) for k, c in text.items()}
    typed = {k: F.when(is_odd & there[k], odd(k, "json")).otherwise(c) for k, c in typed.items()}
    text["problem"] = F.when(final != "", final).otherwise(text["problem"])
    quoted = F.to_json(F.struct(final.alias("v")))
    typed["problem"] = F.when(final != "", F.substr(quoted, F.lit(6), F.length(quoted) - 6)).otherwise(typed["problem"])
    core = F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(f'"{k}": '), c) for k, c in typed.items()]), F.lit("}"))
    return rows.select(*keep, *[c.alias(k) for k, c in text.items()], core.alias("core_json"))


def matches_per_file(selected: DataFrame) -> DataFrame:
    return selected.groupBy("file").agg(F.count(F.lit(1)).alias("matches"))


def total(selected: DataFrame) -> DataFrame:
    return selected.agg(F.count(F.lit(1)).alias("matches"))
