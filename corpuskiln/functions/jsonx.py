"""The JSON semantics that Spark's own functions don't have: key order, lax numbers, repeated keys, two-space layout.

Small helpers for each row, run in Arrow batches; everything around them is DataFrame code.
"""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names of fields.
PROBLEM_KEYS = frozenset(("problem", "题目内容", "问题", "题目"))
MARKER_KEYS = frozenset(("proof", "direct_answer", "source_idx", "source", "题目类型", "预估难度", "答案", "难度", "科目", "题目ID", "知识点"))
STRICT_MARKERS = frozenset(("proof", "direct_answer", "source_idx", "source", "题目类型", "预估难度"))
#: Another name of a field, and the field; the order counts.
ALIASES = (
    ("题目内容", "problem"), ("问题", "problem"), ("题目", "problem"),
    ("题目ID", "source_idx"), ("题号", "source_idx"), ("编号", "source_idx"),
    ("难度", "预估难度"),
    ("答案", "direct_answer"), ("参考答案", "direct_answer"),
    ("科目", "source"), ("来源", "source"),
)


_LONE = re.compile("[\ud800-\udfff]")


def storable(text: str) -> str:
    """JSON text in which half surrogates, which UTF-8 has no bytes for, are escapes again."""
    return _LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def dumps(value, **layout) -> str:
    return storable(json.dumps(value, ensure_ascii=False, **layout))


def is_exercise(node, aliases: bool = True) -> bool:
    if not isinstance(node, dict):
        return False
    named = not PROBLEM_KEYS.isdisjoint(node) if aliases else "problem" in node
    return named and not (MARKER_KEYS if aliases else STRICT_MARKERS).isdisjoint(node)


def exercises_in(document, aliases: bool = True):
    """Exercises at any depth, in document order; one found is not searched further."""
    waiting = [document]
    while waiting:
        node = waiting.pop()
        if is_exercise(node, aliases):
            yield node
        elif isinstance(node, (dict, list)):
            waiting.extend(reversed(list(node.values()) if isinstance(node, dict) else node))


def with_canonical(exercise: dict) -> dict:
    """Canonical fields added at the end from the first other name present; a canonical field that is there stays, even null."""
    added = {}
    for other, field in ALIASES:
        if other in exercise and field not in exercise:
            added.setdefault(field, exercise[other])
    return exercise | added


def rows_of(document) -> list:
    """A list's items, or the one object; other values have no rows."""
    return document if isinstance(document, list) else [document] if isinstance(document, dict) else []


def loads_bytes(content: bytes):
    """Strict UTF-8 without a byte order mark. (value, error). NaN and the infinities, which are no JSON to Spark, become
    texts of that name, so that a row with one is a row like any other."""
    try:
        return json.loads(content.decode("utf-8"), parse_constant=str), None
    except (ValueError, RecursionError) as e:
        return None, f"{type(e).__name__}: {e}"


def parsed(text: str):
    """(value, error) of a JSON text, with NaN and the infinities as they are."""
    try:
        return json.loads(text), None
    except (ValueError, RecursionError) as e:
        return None, f"{type(e).__name__}: {e}"


def _tries(text: str):
    """The texts in which a response's JSON value is looked for, in turn."""
    yield text
    start, end = text.find("```"), text.rfind("```")
    if 0 <= start < end:
        inner = text[start + 3 : end].strip()
        head, newline, rest = inner.partition("\n")
        yield rest.strip() if newline and head.strip().lower() == "json" else inner
    for pair in ("{}", "[]"):
        start, end = text.find(pair[0]), text.rfind(pair[1])
        if 0 <= start < end:
            yield text[start : end + 1]


NO_ORIGINAL = "The original is no JSON object."
#: Fixed values.
EMPTY_OUTPUT, NOT_JSON = "Model returned empty output.", "Model output is not valid JSON."
MANY, NOT_OBJECT, NO_PROBLEM, NOT_STRING = "Output must be a single JSON object, not an array with multiple items.", "Output must decode to a JSON object.", "Output must contain a 'problem' field.", "Field 'problem' must remain a string."
OTHER_KEYS, CHANGED = "The output object must keep exactly the same keys in exactly the same order.", "Field '{}' was modified, but only 'problem' may change."


def value_in(response: str | None):
    """(value, error) of the JSON in a free-form response."""
    text = (response or "").strip()
    if not text:
        return None, EMPTY_OUTPUT
    for part in _tries(text):
        try:
            return json.loads(part), None
        except (ValueError, RecursionError):
            pass
    return None, NOT_JSON


def candidate_error(candidate, original: dict | None = None) -> str:
    """What is wrong with a rewritten exercise; original given: nothing but the problem may differ from it.

    The first condition that holds names the fault."""
    many = isinstance(candidate, list) and len(candidate) != 1
    one = candidate[0] if isinstance(candidate, list) and not many else candidate
    fields = one if isinstance(one, dict) else {}
    kept = fields if original is None else original
    changed = [k for k in kept if k != "problem" and k in fields and fields[k] != kept[k]]
    faults = (
        (many, MANY),
        (fields is not one, NOT_OBJECT),
        (original is None and "problem" not in fields, NO_PROBLEM),
        (list(fields) != list(kept), OTHER_KEYS),
        (changed, CHANGED.format(*changed[:1] or [""])),
        (not isinstance(fields.get("problem"), str), NOT_STRING),
    )
    return next((message for holds, message in faults if holds), "")


def unreadable(raw: Column) -> Column:
    """The JSON texts that Spark's own functions can't take in, such as ones with a number of over a thousand digits or nested
    over a thousand deep; null for all others. Helpers get these alone."""
    return F.when(F.try_parse_json(raw).isNull(), raw)


#: What fields_of tells of a field: its type as Spark names it, its text, and its JSON.
FIELD = T.StructType([T.StructField("kind", T.StringType()), T.StructField("text", T.StringType()), T.StructField("json", T.StringType())])


def _field(value) -> dict:
    kind = {str: "STRING", bool: "BOOLEAN", int: "BIGINT", float: "DOUBLE", list: "ARRAY", dict: "OBJECT"}.get(type(value), "VOID")
    said = dumps(value)
    return {"kind": kind, "text": None if value is None else storable(value) if kind == "STRING" else said, "json": said}


def canonical(value):
    """The value with equal numbers written alike: true and 1.0 as 1. Lists and objects in it are changed where they are."""
    number = lambda x: int(x) if isinstance(x, bool) or isinstance(x, float) and x.is_integer() else x
    waiting = [value]
    while waiting:
        node = waiting.pop()
        for k, x in enumerate(node) if isinstance(node, list) else list(node.items()) if isinstance(node, dict) else ():
            node[k] = number(x)
            if isinstance(x, (list, dict)):
                waiting.append(x)
    return number(value)


def digest(value) -> str | None:
    """One text for all values that are equal, in whatever order their keys are; null for NaN, which equals nothing (within a
    list or object it is like any other value, as comparisons of those have it)."""
    try:
        said = json.dumps(canonical(value), sort_keys=True)
    except RecursionError:
        return None
    return None if said == "NaN" else hashlib.sha256(said.encode()).hexdigest()


#: What digests_of tells of a response: a fault of parsing, whether it is a list of another number of items than one, or a
#: list at all, whether what it has is an object, its fields in order with their values' digests, and whether its problem is a text.
DIGESTS = T.StructType([
    T.StructField("error", T.StringType()), T.StructField("many", T.BooleanType()), T.StructField("listed", T.BooleanType()), T.StructField("is_object", T.BooleanType()), T.StructField("text_problem", T.BooleanType()),
    T.StructField("names", T.ArrayType(T.StringType())), T.StructField("digests", T.ArrayType(T.StringType())),
])


def _digests(text: str | None) -> dict:
    value, error = value_in(text)
    many = isinstance(value, list) and len(value) != 1
    one = value[0] if isinstance(value, list) and not many else value
    fields = one if isinstance(one, dict) else {}
    return {"error": error, "many": many, "listed": isinstance(value, list), "is_object": isinstance(one, dict), "text_problem": isinstance(fields.get("problem"), str), "names": [storable(k) for k in fields], "digests": [digest(v) for v in fields.values()]}


#: Rows of a batch whose values a helper has as Python objects at once.
ROWS = 128


def _each(kind):
    """A function of one row's texts as an Arrow-batched column function."""

    def wrap(f):
        def of(*columns: Column) -> Column:
            import pyarrow as pa
            from pyspark.sql.pandas.types import to_arrow_type

            arrow = to_arrow_type(kind)

            def some(*texts):
                rows = [f(*x) for x in zip(*[t.to_pylist() for t in texts])]
                return pa.array([list(x.items()) if isinstance(x, dict) else x for x in rows] if isinstance(kind, T.MapType) else rows, arrow)

            def all_of(texts):
                parts = [some(*[t.slice(at, ROWS) for t in texts]) for at in range(0, len(texts[0]), ROWS)]
                return pa.concat_arrays(parts) if parts else pa.array([], arrow)

            def one(a: pa.Array) -> pa.Array:
                return all_of([a])

            def two(a: pa.Array, b: pa.Array) -> pa.Array:
                return all_of([a, b])

            run = one if len(columns) == 1 else two
            run.__annotations__ = dict.fromkeys(("a", "b")[: len(columns)], pa.Array) | {"return": pa.Array}
            return F.arrow_udf(run, kind)(*columns)

        of.__name__, of.__doc__ = f.__name__, f.__doc__
        return of

    return wrap


@_each(T.MapType(T.StringType(), FIELD))
def fields_of(raw):
    """The fields of an object as a map of FIELD; null for a null, for what is no JSON and for other values."""
    value = None
    if raw is not None:
        try:
            value = json.loads(raw, parse_constant=str)
            return {storable(k): _field(v) for k, v in value.items()} if isinstance(value, dict) else None
        except (ValueError, RecursionError):
            pass
    return None


@_each(T.ArrayType(DIGESTS))
def digests_of(response):
    """DIGESTS of a response, as the only item of a list."""
    return [_digests(response)]


@_each(T.ArrayType(T.StringType()))
def texts_at(raw, key):
    """A field's texts, without the white space around them: itself or its items; null where fields_of is."""
    if raw is not None:
        try:
            value = json.loads(raw)
            found = value.get(key, []) if isinstance(value, dict) else []
            return [storable(x.strip()) for x in (found if isinstance(found, list) else [found]) if isinstance(x, str)]
        except (ValueError, RecursionError):
            pass
    return None


@_each(T.StringType())
def pretty_json(raw):
    """Two-space layout, non-ASCII characters kept, keys in their order; null for what isn't JSON."""
    try:
        return None if raw is None else dumps(json.loads(raw), indent=2)
    except (ValueError, RecursionError):
        return None


def extract_json(response: Column) -> Column:
    """struct<json, error> of a response."""
    return F.from_json(_extract_json(response), "json string, error string")


@_each(T.StringType())
def _extract_json(response):
    value, error = value_in(response)
    try:
        said = dumps(value, allow_nan=False)
    except ValueError:  # NaN and the infinities become texts, as in loads_bytes
        said = dumps(json.loads(json.dumps(value), parse_constant=str))
    return dumps({"json": None if error else said, "error": error})


@_each(T.StringType())
def check_candidate(response):
    """Error of a response as a rewritten exercise: parsing, then the lenient check."""
    value, error = value_in(response)
    return error or candidate_error(value)


@_each(T.StringType())
def check_candidate_strict(response, original):
    """As check_candidate, and all but the problem must equal the original, which must be an object itself."""
    value, error = value_in(response)
    kept, broken = value_in(original)
    if broken or not isinstance(kept, dict):
        return NO_ORIGINAL
    return error or candidate_error(value, kept)


@_each(T.StringType())
def candidate_problem(response):
    """The problem of a response that passes the lenient check; else null."""
    value, error = value_in(response)
    if error or candidate_error(value):
        return None
    problem = (value[0] if isinstance(value, list) else value)["problem"]
    return problem.encode("utf-16", "surrogatepass").decode("utf-16", "replace")  # half surrogates have no bytes in UTF-8


@_each(T.StringType())
def with_problem(raw, problem):
    """The object with its problem set, in its place or last; unchanged for a null problem, or if it is no object."""
    value, error = (None, NOT_JSON) if raw is None or problem is None else value_in(raw)
    return raw if error or not isinstance(value, dict) else dumps(value | {"problem": problem})
