"""Edge rows of the operators, and a run from files to a report with a made-up model and compiler."""

import json
import os

import pytest
from pyspark.sql import functions as F

from corpuskiln.operators import attempts, contracts, diagnostics, outputs, records, reports, selection
from corpuskiln.plans.workloads import CorpusRun, select_by_type
from corpuskiln.sources import exercises as source


@pytest.fixture
def tree(tmp_path):
    files = {
        "a/b.json": json.dumps([{"题目类型": " 证明题　", "problem": "p", "index": 0}, 3, {"题目类型": ["x", "证明题 "], "problem_finally": " f "}], ensure_ascii=False).encode(),
        "a-b.json": json.dumps({"题目类型": "证明题", "proof": None}, ensure_ascii=False).encode(),
        "c.json": b"{", "d.json": b'"text"', "e.json": "﻿[]".encode(), "f.json": b'["\xff"]', "g.JSON": b"[]", "x y/ü %.json": b"", "z.json": b"[]", "h.json": '[{"题目类型": [1]}, {"题目类型": null}]'.encode(), "_i.json": b"[]",
    }
    for name, content in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    return str(tmp_path)


def test_select_by_type(spark, tree):
    core, counts, bad = select_by_type(spark, tree, "proof_statement")
    rows = source.in_file_order(core).collect()
    assert [(r.file[len("file:" + tree) + 1 :], r.ordinal) for r in rows] == [("a/b.json", 1), ("a/b.json", 3), ("a-b.json", 1)]
    assert [r.problem for r in rows] == ["p", "f", ""] and rows[2].proof is None and rows[0].proof == "" and rows[0]["index"] == "0"
    assert sorted(r.matches for r in counts.collect()) == [1, 2]
    assert sorted(r.file for r in bad.collect()) == sorted(f"file:{tree}/{n}" for n in ("c.json", "e.json", "f.json", "x y/ü %.json"))


LABELS = [
    ('{"source_idx": "s"}', "s", "s"), ('{"source_idx": "", "index": 0}', "9", "9"), ('{"题目ID": 7}', "7", "9"), ('{"index": "0"}', "0", "0"), ('{"source_idx": null, "index": 2.5}', "2.5", "2.5"),
    ('{"source_idx": 0.0, "index": false}', "9", "9"), ('{"source_idx": true}', "True", "True"), ('{"source_idx": []}', "9", "9"),
]


def test_labels(spark):
    rows = spark.createDataFrame([(k, x[0]) for k, x in enumerate(LABELS)], "k int, raw string")
    parsed = F.try_parse_json("raw")
    got = rows.select("k", records.label(parsed, F.lit(9)).alias("a"), records.label(parsed, F.lit(9), True).alias("b")).orderBy("k").collect()
    assert [(r.a, r.b) for r in got] == [x[1:] for x in LABELS]


def test_numbered_names(spark):
    rows = spark.createDataFrame([("0", None), (" 7 ", "s"), ("12345", None), ("-5", None), ("x", "s"), ("", "s"), (None, "a b"), (None, "")], "i string, s string")
    got = [r[0] for r in rows.select(records.numbered_name(F.col("i"), F.col("s"), F.lit(3))).collect()]
    assert got == ["problem_0000.lean", "problem_0007.lean", "problem_12345.lean", "problem_-005.lean", None, None, "problem_a_b.lean", "problem_0003.lean"]


LOG = """preamble
C:/a:b.src:1:2: warning: w1
  more
info: x
s.src:2:0: error: e1
s.src:9:1: warning: says t.src:1:1: error: both
s.src:3:1: error: """


def test_diagnostics(spark):
    logs = spark.createDataFrame([(1, LOG, "tail"), (2, "", ""), (3, None, "s.src:1:99: error: late")], "ex_id int, stdout string, stderr string")
    logs = logs.select("ex_id", diagnostics.joined_log(F.col("stdout"), F.col("stderr")).alias("output"))
    sources = spark.createDataFrame([("s.src", "one\ntwo\n")], "file string, content string")
    rows = diagnostics.with_source_context(diagnostics.parse_diagnostics(logs), sources).orderBy("ex_id", "seq").collect()
    assert [(r.ex_id, r.seq, r.severity, r.line, r.column) for r in rows] == [(1, 1, "warning", 1, 2), (1, 2, "error", 2, 0), (1, 3, "warning", 9, 1), (3, 1, "error", 1, 99)]
    assert rows[0].message == "w1\nmore\ninfo: x" and rows[0].line_content == "[couldn't read file C:/a:b.src]"
    assert rows[1].line_content == "two" and rows[1].char_at_column == "t"
    assert rows[2].message == "says t.src:1:1: error: both\ns.src:3:1: error:\ntail" and rows[2].line_content == "[couldn't read line 9]"
    assert rows[3].line_content == "one" and rows[3].char_at_column == ""
    lists = {r.ex_id: r for r in diagnostics.per_exercise(diagnostics.with_source_context(diagnostics.parse_diagnostics(logs), sources)).collect()}
    assert [w.message[:2] for w in lists[1].warnings] == ["w1", "sa"] and [e.message for e in lists[1].errors] == ["e1"]


def test_verdicts(spark):
    ex = spark.createDataFrame([(1,), (2,), (3,)], "ex_id int")
    logs = spark.createDataFrame([(1, "", 0), (2, "", 1)], "ex_id int, output string, returncode int")
    got = {r.ex_id: (r.returncode, r.is_valid) for r in diagnostics.verdicts(ex, logs, diagnostics.parse_diagnostics(logs).withColumns({"line_content": F.lit(""), "char_at_column": F.lit("")})).collect()}
    assert got == {1: (0, True), 2: (1, False), 3: (-1, False)}


def test_attempts(spark):
    rows = spark.createDataFrame([("a", 1, False, None, "e1"), ("a", 2, True, "r2", None), ("a", 3, True, "r3", None), ("b", 1, False, None, "e1"), ("b", 2, False, None, "e2"), ("b", 4, True, "r4", None)], "ex_id string, attempt int, ok boolean, result string, error string")
    got = {r.ex_id: tuple(r)[1:] for r in attempts.first_accepted(rows, 3).collect()}
    assert got == {"a": (True, 2, "r2", None), "b": (False, 2, None, "e2")}
    rounds = spark.createDataFrame([("a", 1, True, False), ("a", 2, False, True), ("a", 3, True, True), ("b", 1, False, False), ("c", 1, True, False), ("c", 2, False, False)], "ex_id string, attempt int, usable boolean, valid boolean")
    got = {r.ex_id: (r.fixed, r.repair_attempts, r.status) for r in attempts.repair_outcome(rounds, 5).collect()}
    assert got == {"a": (True, 3, "valid"), "b": (False, 0, "repair_failed"), "c": (False, 1, "repair_failed")}


def test_collisions_and_reports(spark):
    rows = spark.createDataFrame([("x", 1, "a"), ("x", 2, "b"), ("y", 3, "")], "file_name string, seq int, code string")
    assert {r.file_name: r.code for r in outputs.resolve_collisions(rows).collect()} == {"x": "b", "y": ""}
    assert {r.file_name: r.code for r in outputs.resolve_collisions(rows, "first").collect()} == {"x": "a", "y": ""}
    assert outputs.with_code(rows).count() == 2
    assert reports.token_totals(spark.createDataFrame([], "prompt_tokens long, completion_tokens long, total_tokens long")).head() == (0, 0, 0)
    calls = spark.createDataFrame([("ab", None, -1, 0, 0, "api"), ("ab", "x", 3, 4, 7, "api_stream")], "prompt string, response string, prompt_tokens long, completion_tokens long, total_tokens long, usage_source string")
    assert [tuple(r)[2:] for r in reports.fill_usage(calls).collect()] == [(1, 0, 1, "estimated"), (3, 4, 7, "api_stream")]


def test_contracts(spark):
    rows = spark.createDataFrame([(1, "Definition: a\nb\nGoal: c"), (2, "no units ∀"), (3, "Remark: x")], "ex_id int, problem string")
    assert [(r.ex_id, r.unit, r.body) for r in contracts.labelled_units(rows).orderBy("ex_id", "nth").collect()] == [(1, "Definition", "a\nb"), (1, "Goal", "c"), (3, "Remark", "x")]
    assert [tuple(r) for r in contracts.unit_flags(rows).orderBy("ex_id").collect()] == [(1, False, 0, True), (2, True, 0, False), (3, False, 1, False)]


def test_files_out_and_back(spark, tmp_path):
    rows = spark.createDataFrame([("a", None), ("é", "x")], "k string, v string")
    source.write_results(rows.coalesce(1), str(tmp_path / "r"))
    lines = sorted(x for p in (tmp_path / "r").glob("part*") for x in p.read_text().splitlines())
    assert lines == ['{"k":"a","v":null}', '{"k":"é","v":"x"}']
    documents = spark.createDataFrame([("f", '{"m": [1, {"problem": "a", "proof": ""}], "z": {"problem": "b", "proof": null}}')], "file string, content string")
    new = spark.createDataFrame([("f", 2, "B")], "file string, ordinal long, problem string")
    assert outputs.write_back(documents, new).head().content == '{"m": [1, {"problem": "a", "proof": ""}], "z": {"problem": "B", "proof": null}}'


def model():
    def ask(prompt):
        if "== Compiler errors ==" in prompt:
            return {"response": "```lean\nfixed\n```" if "hard" not in prompt else ""}
        if prompt.startswith("rewrite"):
            obj = json.loads(prompt.partition("Input JSON object:\n")[2])
            if obj["source_idx"] == "boom":
                raise RuntimeError("down")
            return {"response": json.dumps([{"problem": "Goal: " + obj["problem"]}]), "prompt_tokens": 2, "completion_tokens": 1, "total_tokens": 3, "usage_source": "api"}
        obj = json.loads(prompt.partition("\n\n")[2])
        return {"response": {"ok": "fine", "bad": "broken", "hard": "hard broken", "boom": ""}[obj["source_idx"]]}

    return ask


def compiler():
    return lambda name, content: ("", "", 0) if "broken" not in content else (f"{name}:1:0: error: it broke", "", 1)


def test_full_run(spark, tmp_path):
    body = [{"problem": f"p{k}", "proof": "", "source_idx": k} for k in ("ok", "bad", "hard", "boom")]
    documents = spark.createDataFrame([("f", json.dumps({"all": body}))], "file string, content string")

    def keep(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    run = CorpusRun(model, compiler, keep, {"rewrite": "rewrite", "translate": "translate", "repair": "repair"}, rewrites=2, translations=2, repairs=2)
    out = run(documents)
    got = {r.label: (r.status, r.repair_attempts, r.problem, r.code) for r in out["exercises"].collect()}
    assert got == {
        "ok": ("valid", 0, "Goal: pok", "fine"), "bad": ("valid", 1, "Goal: pbad", "fixed"),
        "hard": ("repair_failed", 0, "Goal: phard", "hard broken"), "boom": ("error", 0, "pboom", None),
    }
    assert tuple(out["summary"].head()) == (4, 2, 1, 1, 0)
    assert out["calls"].where("error IS NOT NULL").count() == 2 and {r.file_name for r in out["files"].collect()} == {"ok.lean", "bad.lean", "hard.lean"}


def strict_model():
    """Rewrites only after feedback; translates the problem it is shown."""

    def ask(prompt):
        if prompt.startswith("rewrite"):
            return {"response": json.dumps({"problem": "Goal: new"}) if "Output parsing failed: Model output is not valid JSON." in prompt else "no"}
        return {"response": "```lean\n" + json.loads(prompt[prompt.index("{") :])["problem"] + "\n```"}

    return ask


def test_rewrites_reach_the_code(spark, tmp_path):
    documents = spark.createDataFrame([("f", json.dumps([{"problem": "old", "proof": "", "source_idx": "one"}]))], "file string, content string")

    def keep(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    out = CorpusRun(strict_model, compiler, keep, {"rewrite": "rewrite", "translate": "translate", "repair": "repair"}, rewrites=2, translations=1, repairs=0)(documents)
    row = out["exercises"].head()
    assert (row.problem, row.code, json.loads(row.raw_json)) == ("Goal: new", "Goal: new", {"problem": "Goal: new", "proof": "", "source_idx": "one"})
    assert out["calls"].where("call_type = 'rewrite'").count() == 2


def test_stream_of_files(spark, tree, tmp_path):
    from corpuskiln.streaming.incremental import select_new

    for _ in range(2):
        select_new(spark, tree, "proof_statement", str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
        assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_report_files_and_pending_stream(spark, tmp_path):
    calls = spark.createDataFrame([("p", "r", 1, 2, 3, "api", "rewrite", "a"), ("p", "", 0, 0, 0, "none", "repair", "b")], "prompt string, response string, prompt_tokens long, completion_tokens long, total_tokens long, usage_source string, call_type string, exercise_label string")
    ex = spark.createDataFrame([(1, "a", "valid", 0), (2, "b", "error", 1)], "ex_id int, label string, status string, repair_attempts int")
    found = spark.createDataFrame([(1, "error"), (1, "warning"), (1, "warning")], "ex_id int, severity string")
    reports.write_report(reports.fill_usage(calls), ex, found, str(tmp_path), "20240101_000000")
    read = lambda name: spark.read.json(str(tmp_path / "token_usage_20240101_000000" / name)).collect()
    assert read("total")[0].total_tokens == 4 and len(read("calls")) == 2
    assert {(r.label, r.num_errors, r.num_warnings) for r in read("exercises")} == {("a", 1, 2), ("b", 0, 0)}
    from corpuskiln.streaming.incremental import pending_batches

    spark.createDataFrame([("x", 1), ("y", 2)], "file_name string, v int").write.parquet(str(tmp_path / "rows"))
    query = pending_batches(spark, str(tmp_path / "rows"), spark.createDataFrame([("x",)], "file_name string")).writeStream.format("memory").queryName("pending").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert [r.file_name for r in spark.table("pending").collect()] == ["y"]


def test_timeouts_become_rows(spark):
    def factory():
        def build(name, content):
            raise TimeoutError("stopped after 120 s")

        return build

    logs = attempts.compile_with(spark.createDataFrame([(1, "a.lean", "x")], "ex_id int, file_name string, content string"), factory, 2)
    row = diagnostics.parse_diagnostics(logs).head()
    assert logs.head().returncode == 1 and (row.line, row.column, row.severity, row.message) == (0, 0, "error", "stopped after 120 s")


ODD = ['{"题目类型": "证明题", "index": NaN, "problem": "n"}', '{"题目类型": "证明题", "problem": "half \\ud800 é"}', '{"题目类型": "证明题", "index": 12345678901234567890123456789012345678901234567890, "source_idx": [1, {"a": 1.5}], "proof": null, "problem_finally": "f\\"q"}']


def test_odd_values_stay(spark):
    """NaN, half surrogates and long numbers neither end the job nor lose their rows; types are kept in core_json."""
    files = [("a", "[" + ", ".join(ODD) + "]"), ("b", "[" + "7" * 5000 + "]"), ("c", "[" * 100_000), ("d", None)]
    good, bad = source.good_and_bad(source.parse_documents(spark.createDataFrame(files, "file string, content string")))
    assert sorted(r.file for r in bad.collect()) == ["b", "c", "d"]
    rows = selection.project_core(selection.filter_by_type(good, "proof_statement")).orderBy("ordinal").collect()
    assert [r["index"] for r in rows] == ["NaN", "", "12345678901234567890123456789012345678901234567890"] and rows[1].problem.startswith("half ")
    core = json.loads(rows[2].core_json)
    assert list(core) == list(selection.CORE_FIELDS) and core["index"] == int(rows[2]["index"]) and core["source_idx"] == [1, {"a": 1.5}] and core["proof"] is None and core["problem"] == 'f"q' and core["direct_answer"] == ""


def test_bad_rows_do_not_end_the_job(spark):
    from corpuskiln.functions import jsonx

    said = ['{"a": "\\ud800"}', '{"n": ' + "7" * 5000 + "}", '{"x": NaN}', "[" * 100_000, None]
    got = [r[0] for r in spark.createDataFrame([(k, x) for k, x in enumerate(said)], "k int, x string").select("k", jsonx.extract_json(F.col("x")).alias("j")).orderBy("k").select("j").collect()]
    assert [g.error for g in got] == [None, jsonx.NOT_JSON, None, jsonx.NOT_JSON, jsonx.EMPTY_OUTPUT] and json.loads(got[2].json) == {"x": "NaN"} and got[0].json
    pairs = [('{"problem": "p"}', "{"), ('{"problem": "p"}', None), ('{"problem": "p"}', "[1]"), ('{"problem": "p"}', '{"problem": "o"}'), ('{"problem": "\\udfff"}', '{"problem": "o"}')]
    rows = spark.createDataFrame([(k, *x) for k, x in enumerate(pairs)], "k int, a string, b string").orderBy("k")
    assert [r[0] for r in rows.select(jsonx.check_candidate_strict(F.col("a"), F.col("b"))).collect()] == [jsonx.NO_ORIGINAL] * 3 + [""] * 2
    assert [r[0] for r in rows.select(jsonx.candidate_problem(F.col("a"))).collect()][:4] == ["p"] * 4
    assert [r[0] for r in rows.select(jsonx.with_problem(F.col("b"), F.lit("new"))).collect()] == ["{", None, "[1]", '{"problem": "new"}', '{"problem": "new"}']
    documents = spark.createDataFrame([("f", '{"problem": "a", "proof": NaN}'), ("g", '{"problem"'), ("h", None)], "file string, content string")
    new = spark.createDataFrame([(f, 1, "B") for f in "fgh"], "file string, ordinal long, problem string")
    done = {r.file: (r.content, r.n_rewritten, r.error is None) for r in outputs.write_back(documents, new).collect()}
    assert done == {"f": ('{"problem": "B", "proof": NaN}', 1, True), "g": ('{"problem"', 0, False), "h": (None, 0, False)}
    logs = spark.createDataFrame([(None, "a.lean:99999999999:1: error: m"), (None, "b.lean:1:1: warning: n\nmore")], "ex_id int, output string")
    found = diagnostics.parse_diagnostics(logs).orderBy("file").collect()
    assert [(r.seq, r.line, r.message) for r in found] == [(1, diagnostics.MOST, "m"), (1, 1, "n\nmore")]


def test_numbers_over_the_corpus_for_any_splitters(spark, monkeypatch):
    rows = [(f"d{k % 5}/f{k % 23}", k) for k in range(200)]
    df = spark.createDataFrame(rows, "file string, ordinal int")
    want = {r: n for n, r in enumerate(sorted(rows, key=lambda r: (r[0].split("/"), r[1])), 1)}
    for n in (1, 4, 256):
        monkeypatch.setattr(records, "SPLITTERS", n)
        assert {(r.file, r.ordinal): r.sequence for r in records.corpus_sequence(df).collect()} == want
    assert records.corpus_sequence(df.limit(0)).count() == 0


def test_header_differences(spark):
    from corpuskiln.functions import prompts

    head = prompts.header_comment({"index": F.lit(3), "problem": F.lit("two\nlines")})
    same = contracts.header_differences(head, {"index": F.lit("3"), "problem": F.lit(" two\nlines ")})
    other = contracts.header_differences(head, {"index": F.lit("4"), "proof": F.lit("x")})
    assert tuple(spark.range(1).select(same, other).head()) == ([], ["index", "problem", "proof"])
    text = "a\nproof: of it\nsource: s\n-/ end"
    named = prompts.header_comment({"index": F.lit(3), "problem": F.lit(text), "proof": F.lit("p")})
    same = contracts.header_differences(named, {"index": F.lit("3"), "problem": F.lit(text), "proof": F.lit("p")})
    other = contracts.header_differences(named, {"index": F.lit("4"), "problem": F.lit(text), "proof": F.lit("q")})
    assert tuple(spark.range(1).select(same, other).head()) == ([], ["index", "proof"])


def test_failed_labels_need_a_group(spark):
    rows = spark.createDataFrame([("f", 2, "b", False), ("f", 1, "a", False), ("g", 1, "c", True)], "file string, seq int, label string, ok boolean")
    assert [tuple(r) for r in attempts.failed_labels(rows, "NOT ok", ["file"]).collect()] == [("f", ["a", "b"])]
    with pytest.raises(ValueError):
        attempts.failed_labels(rows, "NOT ok", [])


def test_source_lines_by_blocks(spark):
    """Lines at the edges of blocks, numbers beyond the file, unknown and null files, and one file that most diagnostics name."""
    n = 3 * diagnostics.BLOCK_LINES
    sources = spark.createDataFrame([("long", "\n".join(f"l{k}" for k in range(1, n + 1))), ("none", None)], "file string, content string")
    wanted = [0, 1, 511, 512, 513, n, n + 1, diagnostics.MOST] + [7] * 500
    rows = [(k, 1, "long", line, 1) for k, line in enumerate(wanted)] + [(1000, 1, "none", 1, 0), (1001, 1, "lost", 3, 0), (1002, 1, None, 3, 0)]
    found = diagnostics.with_source_context(spark.createDataFrame(rows, "ex_id int, seq int, file string, line int, column int"), sources)
    assert found.columns == ["ex_id", "seq", "file", "line", "column", "line_content", "char_at_column"]
    got = {r.ex_id: (r.line_content, r.char_at_column) for r in found.collect()}
    for k, line in enumerate(wanted):
        assert got[k] == ((f"l{line}", str(line)[0]) if 0 < line <= n else (f"[couldn't read line {line}]", ""))
    assert len(got) == len(rows) and got[1000][0] == "[couldn't read line 1]" and got[1001][0] == "[couldn't read file lost]" and got[1002] == (None, "")


def shuffled(spark):
    """Bytes in the shuffle files of this machine."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(k).length() for k in range(files.size()))


def test_source_files_move_once(spark):
    """Many diagnostics at different lines of a file don't each take the file with them, but their line."""
    content = {f"f{k}": "\n".join(os.urandom(2000).hex() for _ in range(200)) for k in range(4)}
    sources = spark.createDataFrame(list(content.items()), "file string, content string")
    rows = [(k, n, f"f{k}", n + 1, 0) for k in range(4) for n in range(100)]
    found = diagnostics.with_source_context(spark.createDataFrame(rows, "ex_id int, seq int, file string, line int, column int"), sources)
    before = shuffled(spark)
    assert found.where("substring(line_content, 1, 1) = char_at_column").count() == len(rows)
    assert shuffled(spark) - before < 2 * sum(map(len, content.values()))


def test_shared_folder(spark, monkeypatch):
    from corpuskiln.sources import shared

    with shared.scratch(spark):
        inner = shared.materialise(spark.range(3))
        outer = shared.materialise(inner, outlive=True)
        path = inner.inputFiles()[0]
    import os

    assert outer.count() == 3 and not os.path.exists(path.removeprefix("file://"))

    class Cluster:
        conf = type("C", (), {"get": lambda self, k, d=None: None})()
        sparkContext = type("S", (), {"master": "spark://host:7077", "getCheckpointDir": lambda self: None})()

    with pytest.raises(ValueError):
        shared.shared_dir(Cluster())


def test_every_row_is_selected_or_quarantined(spark):
    """Numbers of 1,001 and 4,300 digits, nesting of 1,500, a text above 20 MB: all are selected, with their values."""
    kind = '"题目类型": [" 证明题　"]'
    bodies = ['"index": ' + "7" * 1001, '"index": -' + "8" * 4300, '"deep": ' + "[" * 1500 + "]" * 1500 + ', "problem_finally": " f "', '"problem": "' + "é" * 21_000_000 + '", "proof": null', '"source": "' + "[" * 1200 + '"']
    files = [(str(k), "{" + kind + ", " + b + "}") for k, b in enumerate(bodies)] + [("9", "[" * 60_000 + "]" * 60_000)]
    good, bad = source.good_and_bad(source.parse_documents(spark.createDataFrame(files, "file string, content string").repartition(3)))
    assert [r.file for r in bad.collect()] == ["9"]
    chosen = selection.project_core(selection.filter_by_type(good, "proof_statement"))
    got = {r.file: r for r in chosen.select("file", "index", "proof", "source", F.length("problem").alias("n"), F.substring("problem", 1, 2).alias("p"), F.md5("core_json").alias("core"), F.length("core_json").alias("size")).collect()}
    assert set(got) == {"0", "1", "2", "3", "4"} and got["0"]["index"] == "7" * 1001 and got["1"]["index"] == "-" + "8" * 4300
    assert (got["2"].n, got["2"].p) == (1, "f") and got["3"].n == 21_000_000 and got["3"].proof is None and got["3"].size > 21_000_000 and len(got["4"].source) == 1200
    assert {r.type_label: r.matches for r in selection.matches_by_type(good).collect()} == {"证明题": 5}
    core = chosen.where("file = '0'").head().core_json
    assert json.loads(core)["index"] == int("7" * 1001) and list(json.loads(core)) == list(selection.CORE_FIELDS)


def test_labels_of_unreadable_rows(spark):
    from corpuskiln.plans.workloads import load_exercises

    long = "1" * 1001
    body = ['"problem": "a", "proof": "", "source_idx": ' + long, '"problem": "b", "proof": ' + long + ', "source_idx": 0, "index": "i"', '"题目内容": "c", "proof": ' + long + ', "source_idx": [], "index": 0.0']
    rows = load_exercises(spark.createDataFrame([("f", "[" + ",".join("{" + b + "}" for b in body) + "]")], "file string, content string")).orderBy("ordinal").collect()
    assert [(r.label, r.problem) for r in rows] == [(long, "a"), ("i", "b"), ("3", "c")]


def test_strip_is_linear(spark):
    import time

    from corpuskiln.functions import text

    rows = spark.range(1).select(F.concat(F.lit("　\x1c a"), F.repeat(F.lit(" "), 1_000_000), F.lit("b \x85 ")).alias("t"))
    rows.select(F.length(text.strip_ws(F.col("t")))).collect()
    began = time.perf_counter()
    assert rows.select(F.length(text.strip_ws(F.col("t")))).head()[0] == 1_000_002 and time.perf_counter() - began < 1
    every = "".join(chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000)
    df = spark.createDataFrame([(k, c + "x" + c) for k, c in enumerate(every)], "k int, t string")
    assert all(r.s == every[r.k].strip() + "x" + every[r.k].strip() for r in df.select("k", text.strip_ws(F.col("t")).alias("s")).collect())


def test_scratch_is_a_threads_own(spark):
    import threading

    from corpuskiln.sources import shared

    made, entered, leave = {}, threading.Event(), threading.Event()

    def other():
        entered.wait()
        made["b"] = shared.materialise(spark.range(5))
        leave.set()

    thread = threading.Thread(target=other)
    thread.start()
    with shared.scratch(spark):
        made["a"] = shared.materialise(spark.range(3))
        entered.set()
        leave.wait()
    thread.join()
    assert made["b"].count() == 5
    with pytest.raises(Exception):
        made["a"].count()


VALUES = ["1", "1.0", "true", "0", "-0.0", "false", "1e2", "100", "0.5", "5e-1", '"1"', '"NaN"', "NaN", "Infinity", "-Infinity", "null", "[]", "{}", "[1, true]", "[1.0, 1]", '{"a": 1, "b": [2.0]}', '{"b": [2], "a": true}', "9007199254740993", "9007199254740992.0", "7" * 1200, "[[NaN]]", '["\\ud800"]', '"\\u00e9"', '"é"', '[": NaN,"]']


def test_digests_agree_with_equality():
    from corpuskiln.functions import jsonx

    for a in VALUES:
        for b in VALUES:
            x, y = jsonx.digest(json.loads(a)), jsonx.digest(json.loads(b))
            assert (x is not None and x == y) == (json.loads(a) == json.loads(b)), (a, b)


def test_candidates_by_digests(spark):
    from corpuskiln.functions import jsonx

    made = [f'{{"a": {v}, "problem": "p"}}' for v in VALUES[:24]]
    originals = [*made, "[" + made[0] + "]", "{", None, "{}", '{"problem": 3}']
    responses = [*made[1:], made[0], '[{"problem": "p"}]', "```json\n" + made[0] + "\n```", "", None, "3", '{"problem": "p", "a": 1}', '{"a": 1, "problem": [1]}', "[1, 2]", "{}"]
    pairs = [(r, o) for r in responses for o in originals]
    rows = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "ex_id int, response string, original string").repartition(4).cache()
    want = {r.ex_id: r.error for r in rows.select("ex_id", jsonx.check_candidate_strict(F.col("response"), F.col("original")).alias("error")).collect()}
    got = attempts.candidate_errors(attempts.value_digests(rows, "response"), attempts.value_digests(rows, "original"))
    assert {r.ex_id: r.error for r in got.collect()} == want and len(set(want.values())) > 6
    assert attempts.candidate_errors(attempts.value_digests(rows.limit(1), "response"), attempts.value_digests(rows.limit(0), "original")).head().error == jsonx.NO_ORIGINAL


def test_exercises_stored_by_type(spark, tmp_path):
    from corpuskiln.operators import typed

    path = str(tmp_path / "typed")
    bodies = ['{"题目类型": " 证明题　", "index": %d, "source": "s%d", "problem": "p", "extra": 1.50}' % (k, k % 5) for k in range(300)]
    bodies += ['{"题目类型": ["计算题", "证明题"], "index": "i", "problem_finally": " f "}', '{"题目类型": "证明题", "index": ' + "7" * 1500 + "}", '{"题目类型": "选择题"}', "3", '{"题目类型": "其他"}']
    rows = spark.createDataFrame([("f", k, b) for k, b in enumerate(bodies)], "file string, ordinal long, raw_json string").repartition(3)
    typed.write_typed(rows, path)
    for code in ("proof_statement", "calculation", "multiple_choice", "application"):
        want = selection.project_core(selection.filter_by_type(rows, code))
        got = typed.select_typed(spark, path, code)
        assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "EqualTo(is_application,true)" in scan and "raw_json" not in scan and "exercise" not in scan.partition("ReadSchema")[2]
    by_field = spark.read.parquet(path).where(typed.field("source") == "s3").select("ordinal")
    scan = next(line for line in by_field._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
    assert by_field.count() == 60 and "raw_json" not in scan and "EqualTo(exercise" in scan
