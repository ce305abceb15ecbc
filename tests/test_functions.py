"""Edge rows of the column functions."""

import json

import pytest
from pyspark.sql import functions as F

from corpuskiln.functions import code, jsonx, prompts, text


def each(spark, f, values, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r[0] for r in rows.select("k", f(F.col("v")).alias("x")).orderBy("k").select("x").collect()]


def test_strip_agrees_with_python(spark):
    values = ["", " a ", "　a　b ", "\x1c\x1da\x1e\x1f", "\n\t ", "a", "\u2003é\u00a0", "\u200b"]
    assert each(spark, text.strip_ws, values) == [v.strip() for v in values]


def test_lines_agree_with_python(spark):
    values = ["", "a", "a\n", "a\n\nb", "\r\n", "a\rb\x0bc\x0cd\x1ce\x85f\u2028g\u2029", "a\r\n\r\nb\n"]
    assert each(spark, text.split_lines, values) == [v.splitlines() for v in values]


def test_tokens(spark):
    assert each(spark, text.estimate_tokens, ["", None, "  ", "a", "abcd", "abcde", "𝔸𝔹𝔸𝔹𝔸"]) == [0, 0, 0, 1, 1, 2, 2]


def test_stems(spark):
    assert each(spark, text.file_stem, ["", None, "a b", "题²/é", "x.-_y"]) == ["exercise", "exercise", "a_b", "题²_é", "x.-_y"]


FENCED = {
    "": (None, None),
    "  x ": ("x", "x"),
    "```lean\na\n```": ("a", "a"),
    "p ```lean4\na\n``` q": ("a", "p ```lean4\na\n``` q"),
    "```python\na\n```": ("python\na", "```python\na\n```"),
    "```lean\na\n```\nmid\n```\nb\n```": ("a\n```\nmid\n```\nb", "a\n\nb"),
    "```lean\na": ("```lean\na", "```lean\na"),
    "```\n\n```": ("", ""),
}


def test_code_out_of_responses(spark):
    assert each(spark, code.outer_code, list(FENCED)) == [v[0] for v in FENCED.values()]
    assert each(spark, code.block_code, list(FENCED)) == [v[1] for v in FENCED.values()]


def test_code_check(spark):
    assert each(spark, code.check_code, ["", "  ", None, " {x", "[", "hello", "important", "theorem"]) == [code.NO_OUTPUT] * 3 + [code.LOOKS_LIKE_JSON] * 2 + [code.NO_KEYWORD, "", ""]


@pytest.mark.parametrize(
    ("said", "value"),
    [('{"a":1}', {"a": 1}), ('x ```json\n[1]\n``` y', [1]), ("```\n{}\n```", {}), ('say {"a":[1]} now', {"a": [1]}), ('so [{"a":1}] ok', {"a": 1}), ("so [1, 2] ok", [1, 2]), ("null", None), ("NaN", "nan"), ('{"a":1,"a":2}', {"a": 2})],
)
def test_json_out_of_responses(said, value):
    got, error = jsonx.value_in(said)
    assert error is None
    assert got == value or value == "nan" and got != got


@pytest.mark.parametrize("said", ["", "  ", None, '{"a":', '{"a":1}{"b":2}', "words"])
def test_no_json(said):
    assert jsonx.value_in(said)[1]


def test_json_columns(spark):
    rows = spark.createDataFrame([('{"b": 1, "a": "é"}',), (None,), ("cut {",)], "v string")
    got = rows.select(jsonx.pretty_json(F.col("v")).alias("p"), jsonx.extract_json(F.col("v")).alias("x")).collect()
    assert got[0].p == '{\n  "b": 1,\n  "a": "é"\n}' and got[1].p is None and got[2].p is None
    assert got[0].x.json == '{"b": 1, "a": "é"}' and got[0].x.error is None
    assert got[1].x.error == jsonx.EMPTY_OUTPUT and got[2].x.error == jsonx.NOT_JSON


def test_candidates():
    original = {"index": 1, "problem": "p", "proof": ""}
    check = jsonx.candidate_error
    assert check({"problem": "x"}) == "" and check([{"problem": "x"}]) == ""
    assert check([]) == jsonx.MANY and check(3) == jsonx.NOT_OBJECT and check({}) == jsonx.NO_PROBLEM and check({"problem": None}) == jsonx.NOT_STRING
    assert check({"index": 1.0, "problem": "x", "proof": ""}, original) == ""
    assert check({"index": True, "problem": "x", "proof": ""}, original) == ""
    assert check({"problem": "x", "index": 1, "proof": ""}, original) == jsonx.OTHER_KEYS
    assert check({"index": 2, "problem": "x", "proof": ""}, original) == jsonx.CHANGED.format("index")


def test_detection_and_names():
    yes, strict = lambda x: jsonx.is_exercise(x), lambda x: jsonx.is_exercise(x, False)
    assert yes({"问题": "", "知识点": []}) and not yes({"问题": "", "题号": 1}) and not yes({"problem": "", "index": 1}) and not yes([])
    assert strict({"problem": "", "proof": None}) and not strict({"题目内容": "", "proof": ""}) and not strict({"problem": "", "答案": ""})
    assert jsonx.with_canonical({"题目": "b", "题目内容": "a", "source": None, "科目": "s"}) == {"题目": "b", "题目内容": "a", "source": None, "科目": "s", "problem": "a"}
    inner = {"problem": "i", "proof": ""}
    assert list(jsonx.exercises_in({"x": [{"problem": "o", "proof": "", "parts": [inner]}, {"y": inner}], "z": inner})) == [{"problem": "o", "proof": "", "parts": [inner]}, inner, inner]


def test_errors_in_prompts(spark):
    rows = spark.sql("select array(named_struct('line', 1, 'column', 2, 'message', 'm', 'line_content', ''), named_struct('line', 3, 'column', 0, 'message', 'n', 'line_content', ' src')) as e")
    assert rows.select(prompts.render_errors(F.col("e"))).head()[0] == "  line 1:2: m\n  line 3:0: n\n    |  src"
    assert prompts.NO_ERRORS in rows.select(prompts.repair_prompt(F.lit("b"), F.lit("c"), F.lit(None).cast("array<struct<line:int,column:int,message:string,line_content:string>>"))).head()[0]


def test_header_lines(spark):
    got = spark.range(1).select(prompts.header_comment({"index": F.lit(3), "problem": F.lit(None).cast("string")})).head()[0]
    assert got.split("\n")[:2] == ["/-", "index: 3"] and len(got.split("\n")) == 10 and json.dumps("problem: ") and "problem: \n" in got
