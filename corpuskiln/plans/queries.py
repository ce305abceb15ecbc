"""Queries over the driver's tables. Their inputs (exercise files, logs, attempts) are derived from whole tables in Spark;
the SQL beside each computes what must come out from the same tables, without the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions import code, jsonx, prompts, text
from corpuskiln.operators import attempts, contracts, diagnostics, outputs, records, reports, selection
from corpuskiln.sources import exercises as source
from corpuskiln.sources.shared import in_small_batches

QUERIES, ORACLE = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lang_type():
    return F.when(F.col("lang") == "en", "证明题").when(F.col("lang") == "de", "计算题").when(F.col("lang") == "fr", "填空题").otherwise("选择题")


LANG_TYPE = "CASE lang WHEN 'en' THEN '证明题' WHEN 'de' THEN '计算题' WHEN 'fr' THEN '填空题' ELSE '选择题' END"
PY_TRIM = r"regexp_replace(coalesce({}, ''), '^\s+|\s+$', '', 'g')"
TEXT = PY_TRIM.format("text")
#: Documents of a file: few enough for one task at any size of the table.
FILE = "concat('f', lpad(CAST(doc_id DIV 64 AS STRING), 9, '0'))"
FILE_SQL = "'f' || lpad((doc_id // 64)::VARCHAR, 9, '0')"


def raw_exercises(spark, sf_dir: str) -> DataFrame:
    """documents as canonical exercises: the type a text for odd ids and a list with a padded entry for even ones, every
    third with a final text, and fields missing or null by id; some with values that Spark's JSON functions can't read."""
    d = table(spark, sf_dir, "documents")
    q = lambda c: F.to_json(F.struct(c.alias("v")))
    value = lambda c: F.expr(f"substring({c}, 6, length({c}) - 6)")
    d = d.withColumns({"__t": q(F.col("text")), "__s": q(F.col("source")), "__k": lang_type(), "__f": q(F.concat(F.lit("　 "), "text", F.lit("\t")))})
    kind = F.when(F.col("doc_id") % 2 == 1, F.concat(F.lit('"'), "__k", F.lit('"'))).otherwise(F.concat(F.lit('["x", 7, " '), "__k", F.lit('　"]')))
    final = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(', "problem_finally": '), value("__f"))).when(F.col("doc_id") % 3 == 1, ', "problem_finally": "  "').otherwise("")
    proof = F.when(F.col("doc_id") % 4 == 0, ', "proof": null').when(F.col("doc_id") % 4 == 1, ', "proof": "by it"').otherwise("")
    odd = F.when(F.col("doc_id") % 7 == 0, ', "score": NaN').when(F.col("doc_id") % 7 == 1, ', "mark": "\\ud800"').when(F.col("doc_id") % 7 == 2, ', "direct_answer": 12345678901234567890123456789012345678901234567890')
    odd = odd.when(F.col("doc_id") % 7 == 3, F.concat(F.lit(', "direct_answer": '), F.repeat(F.lit("7"), 1500))).when(F.col("doc_id") % 7 == 4, F.concat(F.lit(', "deep": '), F.repeat(F.lit("["), 1500), F.repeat(F.lit("]"), 1500))).otherwise("")
    raw = F.concat(F.lit('{"index": '), F.col("doc_id").cast("string"), odd, F.lit(', "source": '), value("__s"), F.lit(', "题目类型": '), kind, F.lit(', "problem": '), value("__t"), final, proof, F.lit("}"))
    return d.select(F.expr(FILE).alias("file"), F.col("doc_id").alias("ordinal"), raw.alias("raw_json"), "doc_id", "text", "source", "lang")


def as_files(rows: DataFrame) -> DataFrame:
    """(file, content): each file's objects as one JSON list, in order."""
    return rows.groupBy("file").agg(F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "raw_json"))), lambda x: x["raw_json"]), ",\n"), F.lit("]")).alias("content"))


def file_rows(spark, sf_dir: str) -> DataFrame:
    return source.good_and_bad(source.parse_documents(as_files(raw_exercises(spark, sf_dir))))[0]


@query(f"""SELECT {FILE_SQL} AS file, doc_id::VARCHAR AS "index", '' AS source_idx, source,
  CASE WHEN doc_id % 3 = 0 AND {TEXT} <> '' THEN {TEXT} ELSE text END AS problem,
  CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'by it' ELSE '' END AS proof, CASE doc_id % 7 WHEN 2 THEN '12345678901234567890123456789012345678901234567890' WHEN 3 THEN repeat('7', 1500) ELSE '' END AS direct_answer,
  CASE doc_id % 2 WHEN 1 THEN '证明题' ELSE '["x",7," 证明题　"]' END AS type_json, doc_id AS typed_index FROM documents WHERE {LANG_TYPE} = '证明题'""")
def select_by_type(spark, sf_dir: str) -> DataFrame:
    return core_columns(selection.project_core(selection.filter_by_type(file_rows(spark, sf_dir), "proof_statement")))


def core_columns(core: DataFrame) -> DataFrame:
    # core_json of a row with a long number can't be read by Spark either
    fields = jsonx.fields_of(F.col("core_json"))
    return core.withColumn("f", fields).select("file", "index", "source_idx", "source", "problem", "proof", "direct_answer", F.regexp_replace(F.try_element_at("f", F.lit("题目类型"))["text"], ", ", ",").alias("type_json"), F.try_element_at("f", F.lit("index"))["json"].cast("long").alias("typed_index"))


@query(f"""SELECT {LANG_TYPE} AS type_label, count(*)::BIGINT AS matches FROM documents GROUP BY 1""")
def matches_by_type(spark, sf_dir: str) -> DataFrame:
    return selection.matches_by_type(file_rows(spark, sf_dir))


@query(f"""SELECT {FILE_SQL} AS file, count(*)::BIGINT AS matches FROM documents WHERE {LANG_TYPE} = '选择题' GROUP BY 1""")
def matches_per_file(spark, sf_dir: str) -> DataFrame:
    return selection.matches_per_file(selection.filter_by_type(file_rows(spark, sf_dir), "multiple_choice"))


@query(f"""SELECT count(*)::BIGINT AS matches FROM documents WHERE {LANG_TYPE} = '计算题'""")
def matches_total(spark, sf_dir: str) -> DataFrame:
    return selection.total(selection.filter_by_type(file_rows(spark, sf_dir), "calculation"))


def alias_exercises(spark, sf_dir: str) -> DataFrame:
    """Other names by id, sometimes two of one field; every fifth lacks a marker and every seventh holds an exercise itself."""
    d = table(spark, sf_dir, "documents")
    d = d.withColumns({"__t": F.to_json(F.struct(F.col("text").alias("v"))), "__s": F.to_json(F.struct(F.col("source").alias("v")))})
    value = lambda c: F.expr(f"substring({c}, 6, length({c}) - 6)")
    i = F.col("doc_id")
    problem = F.when(i % 3 == 0, F.concat(F.lit('"problem": '), value("__t"))).when(i % 3 == 1, F.concat(F.lit('"题目": "second", "题目内容": '), value("__t"))).otherwise(F.concat(F.lit('"问题": '), value("__t")))
    marker = F.when(i % 5 == 0, F.concat(F.lit('"题号": "n'), i.cast("string"), F.lit('"'))).when(i % 5 == 1, '"题目ID": "", "知识点": ["a"]').when(i % 5 == 2, F.concat(F.lit('"题目ID": '), i.cast("string"), F.lit(', "source": null, "科目": '), value("__s"))).when(i % 5 == 3, F.concat(F.lit('"难度": "hard", "科目": '), value("__s"))).otherwise('"答案": "42", "参考答案": "43", "index": 0')
    inner = F.when(i % 7 == 0, ', "parts": [{"problem": "inner", "proof": ""}]').otherwise("")
    raw = F.concat(F.lit("{"), problem, F.lit(", "), marker, inner, F.lit("}"))
    return d.select(F.expr(FILE).alias("file"), i.alias("ordinal"), raw.alias("raw_json"), "doc_id", "text", "source")


def nested_files(rows: DataFrame) -> DataFrame:
    files = as_files(rows)
    return files.select("file", F.concat(F.lit('{"meta": {"title": "t", "n": 1}, "chapters": [{"items": '), "content", F.lit('}, "loose", 3, null]}')).alias("content"))


@query(f"""WITH d AS (SELECT *, doc_id % 5 = 0 AS bare, doc_id % 7 = 0 AS holds FROM documents),
e AS (SELECT {FILE_SQL} AS file, doc_id, CASE WHEN bare THEN 'inner' ELSE text END AS problem FROM d WHERE NOT bare OR holds)
SELECT file, row_number() OVER (PARTITION BY file ORDER BY doc_id)::BIGINT AS ordinal, md5(problem) AS problem_md5 FROM e""")
def extract_nested(spark, sf_dir: str) -> DataFrame:
    found = source.parse_documents(nested_files(alias_exercises(spark, sf_dir)), "exercises")
    return found.select("file", "ordinal", F.md5(records.problem_text(F.try_parse_json(F.col("raw_json")))).alias("problem_md5"))


@query(f"""SELECT {FILE_SQL} AS file, row_number() OVER (PARTITION BY doc_id // 64 ORDER BY doc_id)::BIGINT AS ordinal, CASE WHEN doc_id % 3 = 0 AND doc_id % 5 IN (2) THEN md5(text) ELSE md5('inner') END AS problem_md5
FROM documents WHERE (doc_id % 3 = 0 AND doc_id % 5 = 2) OR doc_id % 7 = 0""")
def extract_strict(spark, sf_dir: str) -> DataFrame:
    found = source.parse_documents(nested_files(alias_exercises(spark, sf_dir)), "strict")
    return found.select("file", "ordinal", F.md5(records.problem_text(F.try_parse_json(F.col("raw_json")))).alias("problem_md5"))


@query(r"""SELECT doc_id, md5(text) AS problem_md5,
  CASE doc_id % 5 WHEN 0 THEN 'n' || doc_id WHEN 1 THEN '' WHEN 2 THEN doc_id::VARCHAR END AS source_idx,
  CASE doc_id % 5 WHEN 3 THEN 'hard' END AS difficulty, CASE doc_id % 5 WHEN 4 THEN '42' END AS direct_answer,
  CASE doc_id % 5 WHEN 3 THEN source END AS source, doc_id % 5 <> 0 AS detected FROM documents""")
def normalise_aliases(spark, sf_dir: str) -> DataFrame:
    rows = alias_exercises(spark, sf_dir)
    parsed = F.try_parse_json(F.col("raw_json"))
    field = lambda name: F.try_variant_get(records.normalised(parsed, name), "$", "string")
    return rows.select("doc_id", F.md5(field("problem")).alias("problem_md5"), field("source_idx").alias("source_idx"), field("预估难度").alias("difficulty"), field("direct_answer").alias("direct_answer"), field("source").alias("source"), records.is_exercise(F.col("raw_json")).alias("detected"))


@query(r"""SELECT doc_id, CASE WHEN doc_id % 5 = 2 AND doc_id <> 0 THEN doc_id::VARCHAR ELSE (doc_id + 1)::VARCHAR END AS label, (doc_id + 1)::VARCHAR AS legacy_label FROM documents""")
def labels_of(spark, sf_dir: str) -> DataFrame:
    parsed = F.try_parse_json(F.col("raw_json"))
    return alias_exercises(spark, sf_dir).select("doc_id", records.label(parsed, F.col("doc_id") + 1).alias("label"), records.label(parsed, F.col("doc_id") + 1, legacy=True).alias("legacy_label"))


@query(r"""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN format('problem_{:04d}.lean', doc_id) WHEN doc_id % 3 = 1 THEN 'problem_' || regexp_replace(source || '/' || lang || ' ²é-' || doc_id, '[^\p{L}\p{N}_\-.]', '_', 'g') || '.lean' ELSE format('problem_{:04d}.lean', doc_id + 7) END AS file_name,
  CASE WHEN doc_id % 4 = 0 THEN 'exercise' ELSE regexp_replace(source || '|' || doc_id, '[^\p{L}\p{N}_\-.]', '_', 'g') END AS stem FROM documents""")
def file_names(spark, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    name = records.numbered_name(F.when(i % 3 == 0, F.concat(F.lit(" "), i.cast("string"), F.lit("\t"))), F.when(i % 3 == 1, F.concat("source", F.lit("/"), "lang", F.lit(" ²é-"), i.cast("string"))), i + 7)
    stem = text.file_stem(F.when(i % 4 == 0, "").otherwise(F.concat("source", F.lit("|"), i.cast("string"))))
    return table(spark, sf_dir, "documents").select("doc_id", name.alias("file_name"), stem.alias("stem"))


@query(f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id // 64 ORDER BY doc_id)::BIGINT AS in_file, row_number() OVER (ORDER BY doc_id)::BIGINT AS in_corpus FROM documents""")
def sequence_numbers(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.expr(FILE).alias("file"), F.col("doc_id").alias("ordinal"))
    both = records.corpus_sequence(rows).withColumnRenamed("sequence", "in_corpus")
    return records.with_sequence(both).select(F.col("ordinal").alias("doc_id"), F.col("sequence").cast("long").alias("in_file"), F.col("in_corpus").cast("long"))


@query(r"""SELECT 's' || (doc_id % 97) AS file_name, max(doc_id) AS last_id, min(doc_id) AS first_id FROM documents GROUP BY 1""")
def name_collisions(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.concat(F.lit("s"), (F.col("doc_id") % 97).cast("string")).alias("file_name"), F.col("doc_id").alias("seq"))
    last = outputs.resolve_collisions(rows).select("file_name", F.col("seq").alias("last_id"))
    return last.join(outputs.resolve_collisions(rows, "first").select("file_name", F.col("seq").alias("first_id")), "file_name")


@query(r"""SELECT doc_id, doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL) AS pending FROM documents""")
def skip_existing(spark, sf_dir: str) -> DataFrame:
    rows, done = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    waiting = outputs.pending_only(rows, done, "doc_id").withColumn("pending", F.lit(True))
    there, _ = outputs.with_output(rows, done, "doc_id")
    return waiting.unionByName(there.withColumn("pending", F.lit(False)))


#: Events of a log at most, whatever share of them one user has.
BLOCK = 4096
LOG_SQL = f"(user_id * 1000000 + event_id // {BLOCK})"


def log_of() -> Column:
    """A log per user and block of events, as a whole number."""
    return F.expr(f"user_id * 1000000 + event_id DIV {BLOCK}")


def event_lines(spark, sf_dir: str, hot: bool = False) -> DataFrame:
    """A header for each event, a further line after every third; files are documents, all of them, and some that aren't there.
    hot: every third names the first file."""
    e = table(spark, sf_dir, "events")
    files = table(spark, sf_dir, "documents").agg(F.expr("count(*) + count(*) DIV 10 + 1")).scalar()
    i = F.col("event_id")
    line = F.when(i % 101 == 0, "99999999999").otherwise((i % 12 + 1).cast("string"))
    named = F.when(F.lit(hot) & (i % 3 == 0), F.lit(0)).otherwise(i % files)
    head = F.concat(F.lit("src/"), named.cast("string"), F.lit(".src:"), line, F.lit(":"), (i % 40).cast("string"), F.when(F.col("event_type") == "error", ": error: ").otherwise(": warning: "), "event_type", F.lit(" #"), i.cast("string"))
    more = F.when(i % 3 == 0, F.concat(F.lit("\n   note "), i.cast("string"), F.lit(" "))).otherwise("")
    return e.select(log_of().alias("ex_id"), "event_id", "event_type", F.concat(head, more).alias("t"))


def event_logs(spark, sf_dir: str, hot: bool = False, log: Column | None = None) -> DataFrame:
    """The logs, with a line before the first header; log says which an event is in."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "t"))), lambda x: x["t"])
    rows = event_lines(spark, sf_dir, hot)
    return (rows.withColumn("ex_id", log) if log is not None else rows).groupBy("ex_id").agg(F.concat(F.lit("building\n"), F.array_join(lines, "\n")).alias("output"), F.max((F.col("event_type") == "error").cast("int")).alias("returncode"))


EVENT_ROWS = f"""SELECT {LOG_SQL} AS ex_id, event_id, row_number() OVER (PARTITION BY {LOG_SQL} ORDER BY event_id)::BIGINT AS seq, CASE WHEN event_type = 'error' THEN 'error' ELSE 'warning' END AS severity,
  'src/' || (event_id % files) || '.src' AS file, event_id % files AS doc, (CASE WHEN event_id % 101 = 0 THEN 2147483647 ELSE event_id % 12 + 1 END)::INT AS line, (event_id % 40)::INT AS col,
  event_type || ' #' || event_id || CASE WHEN event_id % 3 = 0 THEN chr(10) || 'note ' || event_id ELSE '' END AS message FROM events, (SELECT count(*) + count(*) // 10 + 1 AS files FROM documents)"""
#: The same with each diagnostic's source line.
PLACED_ROWS = f"""WITH e AS ({EVENT_ROWS}), s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
j AS (SELECT e.*, s.doc_id IS NOT NULL AS known, CASE WHEN e.line <= len(s.l) - CASE WHEN s.l[-1] = '' THEN 1 ELSE 0 END THEN s.l[e.line] END AS c FROM e LEFT JOIN s ON e.doc = s.doc_id)
SELECT *, coalesce(c, CASE WHEN known THEN '[couldn''t read line ' || line || ']' ELSE '[couldn''t read file ' || file || ']' END) AS line_content FROM j"""


def document_sources(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.concat(F.lit("src/"), F.col("doc_id").cast("string"), F.lit(".src")).alias("file"), F.col("text").alias("content"))


def placed_diagnostics(spark, sf_dir: str) -> DataFrame:
    return diagnostics.with_source_context(diagnostics.parse_diagnostics(event_logs(spark, sf_dir)), document_sources(spark, sf_dir))


@query(f"""SELECT ex_id, seq, severity, line, col AS "column", message FROM ({EVENT_ROWS})""")
def parse_log(spark, sf_dir: str) -> DataFrame:
    found = diagnostics.parse_diagnostics(event_logs(spark, sf_dir))
    return diagnostics.public_records(found).withColumn("seq", F.col("seq").cast("long"))


@query(f"""SELECT ex_id, seq, line_content, CASE WHEN c IS NOT NULL AND col < length(c) THEN substr(c, col + 1, 1) ELSE '' END AS char_at_column FROM ({PLACED_ROWS})""")
def log_enriched(spark, sf_dir: str) -> DataFrame:
    return placed_diagnostics(spark, sf_dir).select("ex_id", F.col("seq").cast("long"), "line_content", "char_at_column")


HOT_ROWS = PLACED_ROWS.replace("event_id % files", "CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % files END")


@query(f"""SELECT ex_id, seq, line_content, CASE WHEN c IS NOT NULL AND col < length(c) THEN substr(c, col + 1, 1) ELSE '' END AS char_at_column FROM ({HOT_ROWS})""")
def log_hot_file(spark, sf_dir: str) -> DataFrame:
    """As log_enriched, where a third of all diagnostics name one file."""
    found = diagnostics.parse_diagnostics(event_logs(spark, sf_dir, hot=True))
    return diagnostics.with_source_context(found, document_sources(spark, sf_dir)).select("ex_id", F.col("seq").cast("long"), "line_content", "char_at_column")


@query(f"""WITH e AS ({EVENT_ROWS}), x AS (SELECT ex_id, count(*) FILTER (severity = 'error')::BIGINT AS n_errors, count(*) FILTER (severity = 'warning')::BIGINT AS n_warnings, string_agg(message, '|' ORDER BY seq) FILTER (severity = 'error') AS m,
  string_agg(line || ':' || message, '|' ORDER BY seq) FILTER (severity = 'warning') AS w FROM e GROUP BY ex_id)
SELECT ex_id, n_errors, n_warnings, n_errors = 0 AS is_valid, coalesce(m, '') AS error_messages, coalesce(w, '') AS warning_messages FROM x""")
def compile_verdict(spark, sf_dir: str) -> DataFrame:
    logs = event_logs(spark, sf_dir)
    out = diagnostics.verdicts(logs.select("ex_id"), logs, diagnostics.parse_diagnostics(logs))
    said = lambda c, f: F.coalesce(F.array_join(F.transform(c, f), "|"), F.lit(""))
    warned = said("warnings", lambda e: F.concat(e["line"].cast("string"), F.lit(":"), e["message"]))
    return out.select("ex_id", "n_errors", "n_warnings", "is_valid", said("errors", lambda e: e["message"]).alias("error_messages"), warned.alias("warning_messages"))


@query(f"""WITH x AS (SELECT ex_id, string_agg('  line ' || line || ':' || col || ': ' || message || CASE WHEN line_content <> '' THEN chr(10) || '    | ' || line_content ELSE '' END, chr(10) ORDER BY seq) FILTER (severity = 'error') AS m FROM ({PLACED_ROWS}) GROUP BY ex_id)
SELECT ex_id, md5('fix' || chr(10) || chr(10) || '== Lean code ==' || chr(10) || '```lean' || chr(10) || 'code ' || ex_id || chr(10) || '```' || chr(10) || chr(10) || '== Compiler errors ==' || chr(10)
  || coalesce(m, '(no structured errors; returncode was non-zero)') || chr(10) || chr(10) || '{prompts.ONLY_FILE}') AS prompt_md5 FROM x""")
def repair_prompts(spark, sf_dir: str) -> DataFrame:
    prompt = prompts.repair_prompt(F.lit("fix"), F.concat(F.lit("code "), F.col("ex_id").cast("string")), F.col("errors"))
    return diagnostics.per_exercise(placed_diagnostics(spark, sf_dir)).select("ex_id", F.md5(prompt).alias("prompt_md5"))


def event_attempts(spark, sf_dir: str) -> DataFrame:
    """The events of a user and block, eight by eight in time, as attempts of one exercise."""
    e = table(spark, sf_dir, "events").withColumn("log", log_of()).withColumn("nth", F.expr("row_number() OVER (PARTITION BY log ORDER BY ts, event_id) - 1"))
    return e.select(F.concat_ws("-", "log", F.expr("nth DIV 8")).alias("ex_id"), (F.col("nth") % 8 + 1).cast("int").alias("attempt"), "event_type", "event_id")


ATTEMPT_ROWS = f"""SELECT log || '-' || (nth // 8) AS ex_id, (nth % 8 + 1)::INT AS attempt, event_type, event_id FROM (SELECT *, {LOG_SQL} AS log, row_number() OVER (PARTITION BY {LOG_SQL} ORDER BY ts, event_id) - 1 AS nth FROM events)"""


@query(f"""WITH a AS ({ATTEMPT_ROWS}), w AS (SELECT ex_id, min(attempt) FILTER (event_type = 'purchase') AS won, max(attempt) AS tries FROM a WHERE attempt <= 5 GROUP BY ex_id)
SELECT w.ex_id, won IS NOT NULL AS accepted, a.attempt, CASE WHEN won IS NOT NULL THEN 'r' || a.event_id END AS result, CASE WHEN won IS NULL THEN 'bad ' || a.event_type END AS last_error FROM w JOIN a ON a.ex_id = w.ex_id AND a.attempt = coalesce(won, tries)""")
def first_valid_attempt(spark, sf_dir: str) -> DataFrame:
    rows = event_attempts(spark, sf_dir)
    ok = F.col("event_type") == "purchase"
    return attempts.first_accepted(rows.select("ex_id", "attempt", ok.alias("ok"), F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("result"), F.concat(F.lit("bad "), "event_type").alias("error")), 5)


@query(f"""WITH a AS (SELECT * FROM ({ATTEMPT_ROWS}) WHERE attempt <= 5), w AS (SELECT ex_id, min(attempt) FILTER (event_type = 'purchase') AS f, max(attempt) FILTER (event_type <> 'error') AS u FROM a GROUP BY ex_id)
SELECT ex_id, f IS NOT NULL AS fixed, coalesce(f, 0)::INT AS fixed_at, coalesce(f, u, 0)::INT AS repair_attempts, CASE WHEN f IS NULL THEN 'repair_failed' ELSE 'valid' END AS status FROM w""")
def repair_trajectory(spark, sf_dir: str) -> DataFrame:
    rows = event_attempts(spark, sf_dir)
    return attempts.repair_outcome(rows.select("ex_id", "attempt", (F.col("event_type") != "error").alias("usable"), (F.col("event_type") == "purchase").alias("valid")), 5).withColumn("fixed_at", F.coalesce("fixed_at", F.lit(0)))


@query(f"""WITH a AS ({ATTEMPT_ROWS}), w AS (SELECT ex_id, bool_or(event_type = 'purchase') AS ok, min(event_id) AS seq FROM a WHERE attempt <= 5 GROUP BY ex_id)
SELECT split_part(ex_id, '-', 1)::BIGINT AS log_id, string_agg(ex_id, ',' ORDER BY seq) AS failed FROM w WHERE NOT ok GROUP BY 1""")
def failed_label_lists(spark, sf_dir: str) -> DataFrame:
    outcome = event_attempts(spark, sf_dir).where("attempt <= 5").groupBy("ex_id").agg(F.bool_or(F.col("event_type") == "purchase").alias("ok"), F.min("event_id").alias("seq"))
    rows = outcome.select("seq", F.col("ex_id").alias("label"), "ok", F.split_part(F.col("ex_id"), F.lit("-"), F.lit(1)).cast("long").alias("log_id"))
    return attempts.failed_labels(rows, "NOT ok", ["log_id"]).select("log_id", F.array_join("labels", ",").alias("failed"))


def turns(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))


@query(f"""SELECT conv_id, turn, CASE WHEN {TEXT} = '' AND turn % 5 IN (2, 4) THEN NULL ELSE md5(CASE turn % 5 WHEN 3 THEN {TEXT} || chr(10) || '```' || chr(10) || 'gap' || chr(10) || '```' || chr(10) || 'tail' ELSE {TEXT} END) END AS code_md5 FROM conversations""")
def extract_code_outer(spark, sf_dir: str) -> DataFrame:
    t, k = F.col("text"), F.col("turn") % 5
    said = (
        F.when(k == 0, F.concat(F.lit("Here:\n```lean\n"), t, F.lit("\n```\ndone"))).when(k == 1, F.concat(F.lit("```LEAN4 \n"), t, F.lit("\n```"))).when(k == 2, F.concat(F.lit(" 　"), t, F.lit("\n")))
        .when(k == 3, F.concat(F.lit("```\n"), t, F.lit("\n```\ngap\n```\ntail\n```"))).otherwise(t)
    )
    return turns(spark, sf_dir).select("conv_id", "turn", F.md5(code.extract_code(said)).alias("code_md5"))


@query(f"""SELECT conv_id, turn, CASE WHEN {TEXT} = '' AND turn % 3 = 2 THEN NULL ELSE md5(CASE turn % 3 WHEN 0 THEN CASE WHEN {TEXT} = '' THEN 'two' ELSE {TEXT} || chr(10) || chr(10) || 'two' END WHEN 1 THEN '```lean4' || chr(10) || {TEXT} || chr(10) || '```' ELSE {TEXT} END) END AS code_md5 FROM conversations""")
def extract_code_blocks(spark, sf_dir: str) -> DataFrame:
    t, k = text.strip_ws(F.col("text")), F.col("turn") % 3
    said = F.when(k == 0, F.concat(F.lit("a\n```lean\n"), t, F.lit("\n```\nb\n```\n two \n```\n```\n\n```"))).when(k == 1, F.concat(F.lit("```lean4\n"), t, F.lit("\n```"))).otherwise(t)
    return turns(spark, sf_dir).select("conv_id", "turn", F.md5(code.extract_code(said, "blocks")).alias("code_md5"))


@query(r"""SELECT conv_id, turn, CASE turn % 8 WHEN 4 THEN NULL WHEN 7 THEN NULL ELSE md5(coalesce(text, '')) END AS value_md5, CASE WHEN turn % 8 IN (4, 7) THEN 'Model output is not valid JSON.' END AS error FROM conversations""")
def extract_json(spark, sf_dir: str) -> DataFrame:
    k = F.col("turn") % 8
    half = F.expr("substring(to_json(struct(text AS v)), 2)")
    obj = F.to_json(F.struct(F.col("text").alias("v")))
    said = (
        F.when(k == 0, obj).when(k == 1, F.concat(F.lit("Sure!\n```json\n"), obj, F.lit("\n```\n"))).when(k == 2, F.concat(F.lit("```\n"), obj, F.lit("\n```")))
        .when(k == 3, F.concat(F.lit("so it is "), obj, F.lit(" I think"))).when(k == 4, F.concat(F.lit("cut "), F.expr("substring(to_json(struct(text AS v)), 1, length(to_json(struct(text AS v))) - 2)")))
        .when(k == 6, F.concat(F.lit('{"half": "\\ud800", "no": NaN, '), half)).when(k == 7, F.concat(F.lit('{"n": '), F.repeat(F.lit("7"), 5000), F.lit(", "), half)).otherwise(F.concat(F.lit("\n "), obj, F.lit("\t")))
    )
    found = turns(spark, sf_dir).select("conv_id", "turn", jsonx.extract_json(said).alias("x"))
    return found.select("conv_id", "turn", F.md5(F.get_json_object("x.json", "$.v")).alias("value_md5"), F.col("x.error").alias("error"))


CANDIDATE = """CASE doc_id % 6 WHEN 0 THEN '' WHEN 1 THEN {} WHEN 2 THEN {} WHEN 3 THEN 'Field ''problem'' must remain a string.' WHEN 4 THEN {} ELSE 'Output must be a single JSON object, not an array with multiple items.' END"""


def candidates(spark, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    k, i, p = F.col("doc_id") % 6, F.col("doc_id").cast("string"), F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("problem")))
    tail = F.expr("substring(p, 2, length(p) - 2)")
    d = d.withColumns({"p": p, "t": F.expr("substring(to_json(struct(concat('new ', coalesce(text, '')) AS v)), 6, length(to_json(struct(concat('new ', coalesce(text, '')) AS v))) - 6)")})
    told = lambda *parts: F.concat(*[F.lit(x) if x.__class__ is str else x for part in parts for x in ([part] if part.__class__ is not str else [y for z in part.split("@") for y in (z, F.col("t"))][:-1])])  # noqa: E731  @ stands for the rewritten text
    original = F.concat(F.lit('{"index": '), i, F.lit(", "), tail, F.lit(', "proof": "x"}'))
    said = (
        F.when(k == 0, told('[{"index": ', i, '.0, "problem": @, "proof": "x"}]')).when(k == 1, told('{"index": ', i, ', "problem": @, "proof": "y"}'))
        .when(k == 2, told('{"problem": @, "index": ', i, ', "proof": "x"}')).when(k == 3, told('{"index": ', i, ', "problem": [@], "proof": "x"}'))
        .when(k == 4, told('{"index": ', i, ', "note": @, "proof": "x"}')).otherwise(told('[{"problem": @}, {"problem": @}]'))
    )
    original = F.when(F.col("doc_id") % 12 == 11, F.expr("substring(p, 1, length(p) - 2)")).otherwise(original)
    return d.select("doc_id", original.alias("original"), said.alias("response"))


@query(f"""SELECT doc_id, {CANDIDATE.format("''", "''", "'Output must contain a ''problem'' field.'")} AS error FROM documents""")
def candidate_lenient(spark, sf_dir: str) -> DataFrame:
    return candidates(spark, sf_dir).select("doc_id", jsonx.check_candidate(F.col("response")).alias("error"))


KEYS_DIFFER = "'The output object must keep exactly the same keys in exactly the same order.'"


@query("SELECT doc_id, CASE WHEN doc_id % 12 = 11 THEN '" + jsonx.NO_ORIGINAL + "' ELSE " + CANDIDATE.format("'Field ''proof'' was modified, but only ''problem'' may change.'", KEYS_DIFFER, KEYS_DIFFER) + " END AS error FROM documents")
def candidate_strict(spark, sf_dir: str) -> DataFrame:
    return candidates(spark, sf_dir).select("doc_id", jsonx.check_candidate_strict(F.col("response"), F.col("original")).alias("error"))


@query(ORACLE["candidate_strict"])
def candidate_digests(spark, sf_dir: str) -> DataFrame:
    """As candidate_strict, by digests of values that are made once and joined."""
    rows = candidates(spark, sf_dir)
    found = attempts.candidate_errors(attempts.value_digests(rows, "response", "doc_id"), attempts.value_digests(rows, "original", "doc_id"), "doc_id")
    return found.select("doc_id", "error")


@query(f"""WITH t AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'theorem t : ' || text WHEN 1 THEN ' {{' || text WHEN 2 THEN '  ' || chr(10) ELSE text END AS c FROM documents)
SELECT doc_id, CASE WHEN trim(c, ' ' || chr(10)) = '' THEN '{code.NO_OUTPUT}' WHEN ltrim(c) LIKE '{{%' OR ltrim(c) LIKE '[%' THEN '{code.LOOKS_LIKE_JSON}'
  WHEN {" OR ".join(f"contains(c, '{m}')" for m in code.CODE_MARKERS)} THEN '' ELSE '{code.NO_KEYWORD}' END AS error FROM t""")
def code_sanity(spark, sf_dir: str) -> DataFrame:
    k, t = F.col("doc_id") % 4, F.col("text")
    made = F.when(k == 0, F.concat(F.lit("theorem t : "), t)).when(k == 1, F.concat(F.lit(" {"), t)).when(k == 2, "  \n").otherwise(t)
    return table(spark, sf_dir, "documents").select("doc_id", code.check_code(made).alias("error"))


def calls(spark, sf_dir: str) -> DataFrame:
    """A turn as prompt and the next one as response; the counters are 0 for every other one."""
    t = turns(spark, sf_dir)
    answer = t.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    known = F.col("turn") % 2 == 0
    return t.withColumnRenamed("text", "prompt").join(answer, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "prompt", "response", F.when(known, F.col("turn") + 10).otherwise(0).alias("prompt_tokens"), F.when(known, 5).otherwise(0).cast("long").alias("completion_tokens"),
        F.when(known, F.col("turn") + 15).otherwise(0).alias("total_tokens"), F.lit("api").alias("usage_source"), F.col("role").alias("call_type"), F.col("conv_id").cast("string").alias("exercise_label"),
    )


EST = "CASE WHEN {0} = '' THEN 0 ELSE greatest(1, ceil(length({0}) / 4.0)) END::BIGINT"
CALLS = f"""SELECT a.conv_id, a.turn, a.role, CASE WHEN a.turn % 2 = 0 THEN a.turn + 10 ELSE {EST.format(PY_TRIM.format("a.text"))} END AS prompt_tokens, CASE WHEN a.turn % 2 = 0 THEN 5 ELSE {EST.format(PY_TRIM.format("b.text"))} END AS completion_tokens,
  CASE WHEN a.turn % 2 = 0 THEN a.turn + 15 ELSE {EST.format(PY_TRIM.format("a.text"))} + {EST.format(PY_TRIM.format("b.text"))} END AS total_tokens, CASE WHEN a.turn % 2 = 0 THEN 'api' ELSE 'estimated' END AS usage_source
  FROM conversations a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1"""


@query(f"SELECT prompt_tokens::BIGINT AS prompt_tokens, completion_tokens::BIGINT AS completion_tokens, total_tokens::BIGINT AS total_tokens, role AS call_type, conv_id::VARCHAR AS exercise_label, usage_source FROM ({CALLS})")
def usage_rows(spark, sf_dir: str) -> DataFrame:
    return reports.usage_rows(reports.fill_usage(calls(spark, sf_dir))).withColumns({c: F.col(c).cast("long") for c in reports.COUNTERS})


@query(f"SELECT sum(prompt_tokens)::BIGINT AS prompt_tokens, sum(completion_tokens)::BIGINT AS completion_tokens, sum(total_tokens)::BIGINT AS total_tokens FROM ({CALLS})")
def token_totals(spark, sf_dir: str) -> DataFrame:
    return reports.token_totals(reports.fill_usage(calls(spark, sf_dir)))


@query(f"""SELECT conv_id AS call_id, md5({PY_TRIM.format("string_agg(text, '' ORDER BY turn)")}) AS text_md5, arg_max(turn, turn) FILTER (turn % 3 = 0) AS usage FROM conversations GROUP BY conv_id""")
def assemble_chunks(spark, sf_dir: str) -> DataFrame:
    rows = turns(spark, sf_dir).select(F.col("conv_id").alias("call_id"), F.col("turn").alias("seq"), F.col("text").alias("content"), F.when(F.col("turn") % 3 == 0, F.col("turn")).alias("usage"))
    return reports.assemble_chunks(rows).select("call_id", F.md5("text").alias("text_md5"), "usage")


#: What a run left of a document, by its text.
K_SQL = "length(coalesce(text, '')) % 11"
STATE = f"""SELECT doc_id, CASE {K_SQL} WHEN 0 THEN 'pending' WHEN 1 THEN 'error' WHEN 2 THEN 'translated' WHEN 3 THEN 'repair_failed' ELSE 'valid' END AS status FROM documents"""


def states(spark, sf_dir: str) -> DataFrame:
    k = F.length(F.coalesce("text", F.lit(""))) % 11
    translated = F.when(k == 0, F.lit(None).cast("boolean")).otherwise(k != 1)
    fixed = F.when(k == 3, False).when(k == 4, True)
    return table(spark, sf_dir, "documents").select("doc_id", "source", reports.final_status(translated, k > 4, fixed).alias("status"), (k > 3).alias("is_valid"))


@query(f"""SELECT count(*)::BIGINT AS total, count(*) FILTER (status = 'valid')::BIGINT AS valid, count(*) FILTER (status = 'repair_failed')::BIGINT AS repair_failed, count(*) FILTER (status = 'error')::BIGINT AS error,
  count(*) FILTER (status IN ('pending', 'translated'))::BIGINT AS other FROM ({STATE})""")
def status_summary(spark, sf_dir: str) -> DataFrame:
    return reports.status_summary(states(spark, sf_dir))


@query(f"SELECT doc_id, status FROM ({STATE}) WHERE status NOT IN ('error', 'valid')")
def repair_queue(spark, sf_dir: str) -> DataFrame:
    return reports.broken(states(spark, sf_dir)).select("doc_id", "status")


@query(f"""SELECT count(*) FILTER ({K_SQL} > 3)::BIGINT AS written, count(*) FILTER ({K_SQL} <= 3)::BIGINT AS failed FROM documents""")
def conversion_counts(spark, sf_dir: str) -> DataFrame:
    return reports.conversion_counts(states(spark, sf_dir).withColumnRenamed("is_valid", "ok"))


@query(f"""WITH e AS ({EVENT_ROWS}), x AS (SELECT ex_id, count(*) FILTER (severity = 'error') AS a, count(*) FILTER (severity = 'warning') AS b FROM e GROUP BY ex_id),
r AS ({ATTEMPT_ROWS}), w AS (SELECT split_part(ex_id, '-', 1)::BIGINT AS ex_id, count(*) FILTER (event_type <> 'error') AS tries, bool_or(event_type = 'purchase') AS ok FROM r GROUP BY 1)
SELECT x.ex_id, coalesce(c_name, 'nobody') AS label, CASE WHEN ok THEN 'valid' ELSE 'repair_failed' END AS status, tries::BIGINT AS repair_attempts, a::BIGINT AS num_errors, b::BIGINT AS num_warnings FROM x JOIN w USING (ex_id) LEFT JOIN customer ON c_custkey = x.ex_id // 1000000""")
def exercise_report(spark, sf_dir: str) -> DataFrame:
    logs = table(spark, sf_dir, "events").groupBy(log_of().alias("ex_id"), "user_id").agg(F.bool_or(F.col("event_type") == "purchase").alias("ok"), F.count_if(F.col("event_type") != "error").alias("repair_attempts"))
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    who = logs.join(names, "user_id", "left").select("ex_id", F.coalesce("c_name", F.lit("nobody")).alias("label"), F.when(F.col("ok"), "valid").otherwise("repair_failed").alias("status"), "repair_attempts")
    return reports.exercise_report(who, diagnostics.parse_diagnostics(event_logs(spark, sf_dir)))


@query(f"""SELECT {FILE_SQL} AS file, count(*) FILTER (doc_id % 5 = 0)::BIGINT AS n_rewritten, md5(string_agg(CASE WHEN doc_id % 5 = 0 THEN 'new ' || doc_id ELSE text END, chr(1) ORDER BY doc_id)) AS problems_md5, false AS broken FROM documents WHERE (doc_id // 64) % 9 <> 4 GROUP BY 1
UNION ALL SELECT DISTINCT {FILE_SQL}, 0::BIGINT, NULL, true FROM documents WHERE (doc_id // 64) % 9 = 4""")
def write_back(spark, sf_dir: str) -> DataFrame:
    rows = raw_exercises(in_small_batches(spark), sf_dir)
    cut = F.expr("CAST(substring(file, 2) AS BIGINT) % 9 = 4")  # every ninth file is cut off in the middle
    files = nested_files(rows).withColumn("content", F.when(cut, F.expr("substring(content, 1, length(content) DIV 2)")).otherwise(F.col("content")))
    found = source.parse_documents(files, "exercises").withColumn("odd", jsonx.fields_of(jsonx.unreadable(F.col("raw_json"))))
    parsed, odd = F.try_parse_json(F.col("raw_json")), F.col("odd")
    own = F.coalesce(records.text_of(parsed, "index"), F.try_element_at(odd, F.lit("index"))["text"])
    new = found.select("file", "ordinal", own.cast("long").alias("id")).where("id % 5 = 0").select("file", "ordinal", F.concat(F.lit("new "), F.col("id").cast("string")).alias("problem"))
    done = outputs.write_back(files, new)
    again = source.parse_documents(done, "exercises").withColumn("odd", jsonx.fields_of(jsonx.unreadable(F.col("raw_json")))).select("file", "ordinal", records.problem_text(parsed, odd).alias("problem"))
    texts = again.groupBy("file").agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "problem"))), lambda x: x["problem"]), "\x01")).alias("problems_md5"))
    return done.select("file", "n_rewritten", F.col("error").isNotNull().alias("broken")).join(texts, "file", "left").withColumn("problems_md5", F.when(~F.col("broken"), F.col("problems_md5")))


@query(r"""SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'new' ELSE text END <> text AS changed FROM documents""")
def before_and_after(spark, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ex_id"), F.col("text").alias("problem"))
    return outputs.before_and_after(d, d.where("ex_id % 4 = 0").withColumn("problem", F.lit("new"))).select(F.col("ex_id").alias("doc_id"), "changed")


PRETTY = """'{' || chr(10) || '  "index": ' || doc_id || ',' || chr(10) || '  "problem": "' || replace(replace(replace(coalesce(text, ''), '\\', '\\\\'), '"', '\\"'), chr(10), '\\n') || '",' || chr(10) || '  "tags": [' || chr(10) || '    "é",' || chr(10) || '    1.5' || chr(10) || '  ],' || chr(10) || '  "none": {}' || chr(10) || '}'"""


@query(f"""SELECT doc_id, md5('base' || chr(10) || chr(10) || '{prompts.ONE_OBJECT}' || CASE WHEN doc_id % 2 = 0 THEN chr(10) || chr(10) || '{prompts.FEEDBACK}' || chr(10) || 'bad' || chr(10) ELSE '' END || chr(10) || chr(10) || 'Input JSON object:' || chr(10) || {PRETTY}) AS rewrite_md5,
  md5('base' || chr(10) || chr(10) || {PRETTY}) AS plain_md5,
  md5('base' || chr(10) || chr(10) || 'Input JSON object:' || chr(10) || {PRETTY} || CASE WHEN doc_id % 3 = 0 THEN chr(10) || chr(10) || '[Retry] The previous output was invalid: no' || chr(10) || '{prompts.ONLY_CODE}' ELSE '' END) AS headed_md5 FROM documents""")
def prompt_build(spark, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit('{"index": '), F.col("doc_id").cast("string"), F.lit(', "problem": '), F.expr("substring(to_json(struct(coalesce(text, '') AS v)), 6, length(to_json(struct(coalesce(text, '') AS v))) - 6)"), F.lit(', "tags": ["é", 1.5], "none": {}}'))
    base, i = F.lit("base"), F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(prompts.rewrite_prompt(base, raw, F.when(i % 2 == 0, "bad").otherwise(""))).alias("rewrite_md5"), F.md5(prompts.translate_prompt(base, raw)).alias("plain_md5"),
        F.md5(prompts.translate_prompt(base, raw, "headed", F.when(i % 3 == 0, "no"))).alias("headed_md5"),
    )


HEAD = """'/-' || chr(10) || 'index: ' || doc_id || chr(10) || 'source_idx: ' || chr(10) || 'source: ' || source || chr(10) || '题目类型: ' || lang || chr(10) || '预估难度: ' || chr(10) || 'problem: ' || text || chr(10) || 'proof: ' || chr(10) || 'direct_answer: 7' || chr(10) || '-/'"""


@query(f"SELECT doc_id, md5({HEAD}) AS comment_md5, source AS back_source, md5(text) AS back_problem_md5, '7' AS back_answer, CASE WHEN doc_id % 3 = 0 THEN 'source,direct_answer' ELSE '' END AS differing FROM documents")
def header_comment(spark, sf_dir: str) -> DataFrame:
    head = prompts.header_comment({"index": F.col("doc_id"), "source": F.col("source"), "题目类型": F.col("lang"), "problem": F.col("text"), "direct_answer": F.lit("7")})
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text", head.alias("code"))
    back, other = contracts.parse_header(F.col("code")), F.col("doc_id") % 3 == 0
    own = {"index": F.col("doc_id"), "source": F.when(other, F.concat("source", F.lit("!"))).otherwise(F.col("source")), "题目类型": F.col("lang"), "problem": F.col("text"), "direct_answer": F.when(~other, "7")}
    return rows.select("doc_id", F.array_join(contracts.header_differences(F.col("code"), own), ",").alias("differing"), F.md5("code").alias("comment_md5"), back["source"].alias("back_source"), F.md5(back["problem"]).alias("back_problem_md5"), back["direct_answer"].alias("back_answer"))


@query(r"""SELECT doc_id, doc_id % 2 = 0 OR regexp_matches(coalesce(text, ''), '[∀-⋿←-⇿α-ωℕℝℤ]') AS has_symbols, md5(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))) AS definition_md5, CASE WHEN doc_id % 3 = 1 THEN 1 ELSE 0 END::BIGINT AS unknown_units, doc_id % 3 <> 2 AS has_goal, CASE doc_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 1 END::BIGINT AS n_units FROM documents""")
def contract_units(spark, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    one_line = F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ")
    body = F.concat(F.lit("Definition: "), one_line, F.when(i % 2 == 0, "∀ x").otherwise(""), F.lit("\n"), F.when(i % 3 == 1, F.concat(F.lit("Remark: "), F.col("source"), F.lit("\n"))).otherwise(""), F.when(i % 3 != 2, "Goal: x = x").otherwise(""))
    rows = table(spark, sf_dir, "documents").select(i.alias("ex_id"), body.alias("problem"))
    said = F.regexp_replace(F.max(F.when(F.col("unit") == "Definition", F.col("body"))), "∀ x$", "")
    n = contracts.labelled_units(rows).groupBy("ex_id").agg(F.count(F.lit(1)).alias("n_units"), F.md5(F.trim(said)).alias("definition_md5"))
    return contracts.unit_flags(rows).join(n, "ex_id").withColumnRenamed("ex_id", "doc_id")


@query(r"""WITH t AS (SELECT doc_id, doc_id % 4 + len(regexp_extract_all(coalesce(text, ''), '(?m)^[ \t\n\x0b\f\r]*(theorem|lemma)\b')) AS s, doc_id % 3 + len(regexp_extract_all(coalesce(text, ''), '\bsorry\b')) AS p FROM documents)
SELECT doc_id, s::INT AS statements, p::INT AS placeholders, doc_id % 2 = 1 AS missing_import, s > p AS unproved_shape FROM t""")
def contract_flags(spark, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    made = F.concat(F.when(i % 2 == 0, "import Mathlib\n").otherwise("import Std\n"), F.repeat(F.lit("theorem t : True\n"), (i % 4).cast("int")), F.repeat(F.lit("  sorry\n"), (i % 3).cast("int")), F.coalesce("text", F.lit("")))
    return table(spark, sf_dir, "documents").select("doc_id", *[c.alias(k) for k, c in contracts.code_flags(made).items()])


@query(r"""SELECT doc_id, CASE WHEN doc_id % 10 = 3 THEN 0 ELSE 1 END::BIGINT AS n_rows, doc_id % 10 = 3 AS bad FROM documents""")
def quarantine(spark, sf_dir: str) -> DataFrame:
    """One file a document; every tenth is cut off in the middle."""
    rows = raw_exercises(spark, sf_dir)
    content = F.when(F.col("doc_id") % 10 == 3, F.expr("substring(raw_json, 1, length(raw_json) DIV 2)")).otherwise(F.col("raw_json"))
    parsed = source.parse_documents(rows.select(F.col("doc_id").cast("string").alias("file"), content.alias("content")))
    return parsed.groupBy(F.col("file").cast("long").alias("doc_id")).agg(F.count_if(F.col("error").isNull()).alias("n_rows"), F.bool_or(F.col("error").isNotNull()).alias("bad"))


@query(r"""SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events""")
def run_stamps(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", text.run_stamp(F.col("ts")).alias("stamp"))


@query(f"""SELECT doc_id, length(t) AS n_stripped, {EST.format('t')} AS n_tokens, len(string_split(text, chr(10))) - CASE WHEN text LIKE '%' || chr(10) OR text = '' THEN 1 ELSE 0 END AS n_lines FROM (SELECT doc_id, coalesce(text, '') AS text, {PY_TRIM.format('text')} AS t FROM documents)""")
def text_measures(spark, sf_dir: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    padded = F.concat(F.lit("　\n"), t, F.lit("\x1c "))
    return table(spark, sf_dir, "documents").select("doc_id", F.length(text.strip_ws(padded)).cast("long").alias("n_stripped"), text.estimate_tokens(padded).alias("n_tokens"), F.size(text.split_lines(t)).cast("long").alias("n_lines"))


@query(f"""WITH e AS ({EVENT_ROWS}) SELECT DISTINCT file FROM e""")
def mentioned_files(spark, sf_dir: str) -> DataFrame:
    return diagnostics.parse_diagnostics(event_logs(spark, sf_dir)).select("file").distinct()
