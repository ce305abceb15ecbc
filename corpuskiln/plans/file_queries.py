"""Queries that go through files in the shared folder, and through a model and a compiler that are plain functions."""

from __future__ import annotations

import json
from contextlib import suppress

from pyspark.errors import PythonException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.functions import jsonx
from corpuskiln.operators import attempts, diagnostics, outputs, records, reports, selection, typed
from corpuskiln.operators.ledger import CallLedger
from corpuskiln.plans.queries import BLOCK, EVENT_ROWS, FILE, FILE_SQL, K_SQL, LANG_TYPE, LOG_SQL, ORACLE, alias_exercises, as_files, calls, CALLS, core_columns, event_lines, event_logs, file_rows, lang_type, log_of, nested_files, query, raw_exercises, states, table
from corpuskiln.plans.workloads import CorpusRun
from corpuskiln.sources import exercises as source
from corpuskiln.sources.generations import Generations
from corpuskiln.sources.huge_json import parse_huge_documents
from corpuskiln.sources.shared import in_small_batches, materialise, new_path
from corpuskiln.streaming.incremental import first_names, last_names, latest, pending_batches, select_new


def written_tree(spark, sf_dir: str) -> str:
    """A tree of JSON files, one for 64 documents in a folder of its own: an object whose list has the exercises."""
    d = table(spark, sf_dir, "documents").withColumns({"题目类型": lang_type(), "file": F.expr(FILE)})
    items = F.array_sort(F.collect_list(F.struct("doc_id", F.col("doc_id").alias("index"), "source", "题目类型", F.col("text").alias("problem"))))
    path = new_path(spark)
    d.groupBy("file").agg(items.alias("items")).repartition("file").write.partitionBy("file").json(path)
    return path


def file_of(path: F.Column) -> F.Column:
    return F.regexp_extract(path, "file=([^/]*)/", 1)


@query(f"""SELECT {FILE_SQL} AS file, (doc_id % 64 + 1)::BIGINT AS ordinal, doc_id::VARCHAR AS label, md5(coalesce(text, '')) AS problem_md5, lag(doc_id) OVER (PARTITION BY doc_id // 64 ORDER BY doc_id)::VARCHAR AS before FROM documents""")
def read_tree(spark, sf_dir: str) -> DataFrame:
    """A tree of files read, its exercises found at depth, in file order."""
    found = source.parse_documents(source.read_documents(spark, written_tree(spark, sf_dir)), "exercises")
    parsed = F.try_parse_json("raw_json")
    rows = found.select(file_of(F.col("file")).alias("file"), "ordinal", F.coalesce(records.text_of(parsed, "index"), F.lit("")).alias("label"), F.md5(records.problem_text(parsed)).alias("problem_md5"))
    placed = source.in_file_order(rows).withColumn("at", F.monotonically_increasing_id())
    return placed.withColumn("before", F.lag("label").over(Window.partitionBy("file").orderBy("at"))).drop("at")


@query(f"""SELECT doc_id::VARCHAR AS label, md5(coalesce(text, '')) AS problem_md5 FROM documents WHERE {LANG_TYPE} = '填空题'""")
def streamed_selection(spark, sf_dir: str) -> DataFrame:
    """The files as a stream, taken up where the first run has left off: the second finds none."""
    out, checkpoint, ready = new_path(spark), new_path(spark), new_path(spark)
    items = spark.read.json(written_tree(spark, sf_dir)).select("file", F.to_json("items").alias("content"))
    items.repartition("file").write.partitionBy("file").text(ready)
    for _ in range(2):
        select_new(spark, ready, "fill_blank", out, checkpoint, "*.txt").awaitTermination()
    return spark.read.parquet(out).select(F.col("index").alias("label"), F.md5("problem").alias("problem_md5"))


@query(f"""SELECT doc_id, md5(coalesce(text, '')) AS text_md5, doc_id % 3 = 0 AS no_lang FROM documents""")
def result_lines(spark, sf_dir: str) -> DataFrame:
    """Results written as one object a line, nulls kept, and read again."""
    path = new_path(spark)
    d = table(spark, sf_dir, "documents")
    source.write_results(d.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("lang")), path)
    rows = source.read_ndjson(spark, path)
    nulls = records.has_key(F.col("raw_json"), "lang") & F.get_json_object("raw_json", "$.lang").isNull()
    return rows.select(F.get_json_object("raw_json", "$.doc_id").cast("long").alias("doc_id"), F.md5(F.get_json_object("raw_json", "$.text")).alias("text_md5"), nulls.alias("no_lang"))


@query(r"""SELECT 'n' || (doc_id % 97) || '.lean' AS file_name, 'code ' || max(doc_id) || chr(10) || 'end' AS content FROM documents WHERE length(coalesce(text, '')) > 0 GROUP BY 1""")
def exported_files(spark, sf_dir: str) -> DataFrame:
    """A file of each name with exactly the code of the last row that has it, read again by its name; rows without code have none."""
    d = table(spark, sf_dir, "documents")
    code = F.when(F.length("text") > 0, F.concat(F.lit("code "), F.col("doc_id").cast("string"), F.lit("\nend"))).otherwise("")
    rows = outputs.with_code(d.select(F.concat(F.lit("n"), (F.col("doc_id") % 97).cast("string"), F.lit(".lean")).alias("file_name"), F.col("doc_id").alias("seq"), code.alias("code")))
    path = new_path(spark)
    source.export_files(outputs.resolve_collisions(rows).select("file_name", F.col("code").alias("content")), path)
    return source.read_exported(spark, path)


@query(f"""SELECT doc_id, ranked AS same_name, nth FROM (SELECT doc_id, count(*) OVER (PARTITION BY lang, length(coalesce(text, '')) // 16)::BIGINT AS ranked, row_number() OVER (PARTITION BY lang, length(coalesce(text, '')) // 16 ORDER BY doc_id)::INT AS nth FROM documents)""")
def shared_names(spark, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    rows = d.select("doc_id", F.concat_ws("-", "lang", F.expr("length(coalesce(text, '')) DIV 16")).alias("file_name"))
    return outputs.ranked_names(rows, order="doc_id").select("doc_id", "same_name", "nth")


@query(f"""WITH e AS ({EVENT_ROWS}), x AS (SELECT ex_id, count(*) FILTER (severity = 'error') AS a, count(*) FILTER (severity = 'warning') AS b FROM e GROUP BY ex_id)
SELECT 'exercise' AS part, ex_id::VARCHAR AS label, a::BIGINT AS x, b::BIGINT AS y, NULL::BIGINT AS z FROM x UNION ALL
SELECT 'call', conv_id || '/' || role, prompt_tokens::BIGINT, completion_tokens::BIGINT, total_tokens::BIGINT FROM ({CALLS}) UNION ALL
SELECT 'total', '', sum(prompt_tokens)::BIGINT, sum(completion_tokens)::BIGINT, sum(total_tokens)::BIGINT FROM ({CALLS})""")
def report_files(spark, sf_dir: str) -> DataFrame:
    """A run's report written to its folder and read again, its three parts one below the other."""
    path, found = new_path(spark), diagnostics.parse_diagnostics(event_logs(spark, sf_dir))
    who = table(spark, sf_dir, "events").select(log_of().alias("ex_id")).distinct().select("ex_id", F.col("ex_id").cast("string").alias("label"), F.lit("valid").alias("status"), F.lit(0).alias("repair_attempts"))
    reports.write_report(reports.fill_usage(calls(spark, sf_dir)), who, found, path, "20240101_000000")
    read = lambda name, label, *c: spark.read.json(f"{path}/token_usage_20240101_000000/{name}").select(F.lit(name.rstrip("s")).alias("part"), label.alias("label"), *[F.expr(x).cast("long").alias(y) for x, y in zip(c, "xyz")])
    tokens = ("prompt_tokens", "completion_tokens", "total_tokens")
    return read("exercises", F.col("label"), "num_errors", "num_warnings", "NULL").unionByName(read("calls", F.concat_ws("/", "exercise_label", "call_type"), *tokens)).unionByName(read("total", F.lit(""), *tokens))


@query(f"""WITH e AS (SELECT *, row_number() OVER (PARTITION BY {LOG_SQL}, event_type = 'error' ORDER BY event_id) AS nth, count(*) FILTER (event_type <> 'error') OVER (PARTITION BY {LOG_SQL}) AS n_out FROM events)
SELECT {LOG_SQL} AS ex_id, event_id, (nth + CASE WHEN event_type = 'error' THEN n_out ELSE 0 END)::BIGINT AS seq FROM e""")
def joined_logs(spark, sf_dir: str) -> DataFrame:
    """Warnings on standard output, errors on standard error, joined to one log."""
    lines = event_lines(spark, sf_dir)
    side = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(c, F.struct("event_id", "t")))), lambda x: x["t"]), "\n")
    both = lines.groupBy("ex_id").agg(side(F.col("event_type") != "error").alias("stdout"), F.nullif(side(F.col("event_type") == "error"), F.lit("")).alias("stderr"))
    found = diagnostics.parse_diagnostics(both.select("ex_id", diagnostics.joined_log(F.col("stdout"), F.col("stderr")).alias("output")))
    return found.select("ex_id", F.regexp_extract("message", r" #(\d+)", 1).cast("long").alias("event_id"), "seq")


@query(f"""SELECT split_part(ex_id::VARCHAR, '.', 1)::BIGINT AS log, seq, severity, file AS named, line, col AS "column", message FROM ({EVENT_ROWS.replace(LOG_SQL, f"(event_id // {BLOCK})")})""")
def log_files(spark, sf_dir: str) -> DataFrame:
    """Logs of thousands of lines as files, read in ranges that end anywhere, their diagnostics numbered through each file."""
    path = new_path(spark)
    logs = event_logs(spark, sf_dir, log=F.expr(f"event_id DIV {BLOCK}"))
    source.export_files(logs.select(F.concat(F.col("ex_id").cast("string"), F.lit(".log")).alias("file_name"), F.col("output").alias("content")), path)
    found = materialise(diagnostics.parse_log_files(spark, path, 1 << 15), session=spark)
    return found.select(F.regexp_extract("file", r"([0-9]+)\.log$", 1).cast("long").alias("log"), F.col("seq").cast("long").alias("seq"), "severity", "named", "line", "column", "message")


#: Documents of a file of many ranges.
MANY = 4096


@query(f"""SELECT count(*) FILTER ({K_SQL} > 3)::BIGINT AS written, count(*) FILTER ({K_SQL} <= 3)::BIGINT AS failed, (SELECT sum(prompt_tokens) FROM ({CALLS}))::BIGINT AS prompt_tokens,
  (SELECT sum(completion_tokens) FROM ({CALLS}))::BIGINT AS completion_tokens, (SELECT sum(total_tokens) FROM ({CALLS}))::BIGINT AS total_tokens FROM documents""")
def counted_writes(spark, sf_dir: str) -> DataFrame:
    """Results and calls written, their counts taken on the way."""
    found = reports.write_counted(states(spark, sf_dir), new_path(spark), **reports.conversion_aggregates(F.col("is_valid")))
    found |= reports.write_counted(reports.fill_usage(calls(spark, sf_dir)), new_path(spark), **reports.token_aggregates())
    return spark.createDataFrame([found], ", ".join(f"{c} long" for c in found))


@query("""WITH n AS (SELECT doc_id, 's' || (doc_id % 997) AS file_name, doc_id % 3 AS batch FROM documents),
p AS (SELECT * FROM n WHERE file_name NOT IN (SELECT 's' || (doc_id % 997) FROM labels WHERE doc_id % 7 = 0))
SELECT file_name, arg_min(doc_id, (batch, doc_id)) AS first_id, max(doc_id) AS last_id, count(*)::BIGINT AS same_name FROM p GROUP BY file_name""")
def streamed_names(spark, sf_dir: str) -> DataFrame:
    """Rows of names that come in three batches, the stream begun anew for each: who is first stays, and who is last wins; names
    whose file exists are left out."""
    inbox, first, last, marks = new_path(spark), new_path(spark), new_path(spark), new_path(spark)
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("s"), (F.col("doc_id") % 997).cast("string")).alias("file_name"), F.col("doc_id").alias("seq"))
    done = table(spark, sf_dir, "labels").where("doc_id % 7 = 0").select(F.concat(F.lit("s"), (F.col("doc_id") % 997).cast("string")).alias("file_name"))
    for k in range(3):
        d.where(F.col("seq") % 3 == k).write.mode("append").parquet(inbox)
        for names, out in ((first_names, first), (last_names, last)):
            names(pending_batches(spark, inbox, done), out, f"{marks}/{names.__name__}").awaitTermination()
    kept = spark.read.parquet(first).select("file_name", F.col("seq").alias("first_id"))
    return kept.join(latest(spark.read.parquet(last)).select("file_name", F.col("seq").alias("last_id"), "same_name"), "file_name")


@query(ORACLE["select_by_type"])
def typed_selection(spark, sf_dir: str) -> DataFrame:
    """The same from exercises stored by type."""
    path = new_path(spark)
    typed.write_typed(file_rows(spark, sf_dir), path)
    return core_columns(typed.select_typed(spark, path, "proof_statement"))


@query(f"""SELECT {FILE_SQL} AS file, count(*) FILTER (doc_id % 5 = 0 AND (doc_id // 64) % 3 = 1)::BIGINT AS n_new, md5(string_agg(CASE WHEN doc_id % 5 = 0 AND (doc_id // 64) % 3 = 1 THEN 'new ' || doc_id ELSE text END, chr(1) ORDER BY doc_id)) AS problems_md5,
  CASE (doc_id // 64) % 3 WHEN 1 THEN 1 ELSE 0 END::BIGINT AS generation FROM documents GROUP BY ALL""")
def generations_of_documents(spark, sf_dir: str) -> DataFrame:
    """A store of documents, every third of which is rewritten: what is read after that, and which generation wrote each."""
    store, rows = Generations(spark, new_path(spark)), raw_exercises(spark, sf_dir)
    first = store.commit(as_files(rows))
    new = rows.where("doc_id % 5 = 0 AND doc_id DIV 64 % 3 = 1").select("file", (F.expr("doc_id % 64") + 1).alias("ordinal"), F.concat(F.lit("new "), F.col("doc_id").cast("string")).alias("problem"))
    outputs.write_back_changes(store, new, aliases=False)
    found = source.parse_documents(store.documents(), "rows").select("file", "ordinal", F.get_json_object("raw_json", "$.problem").alias("problem"), F.col("raw_json"))
    problem = F.coalesce("problem", F.try_element_at(jsonx.fields_of(jsonx.unreadable(F.col("raw_json"))), F.lit("problem"))["text"])
    texts = found.select("file", "ordinal", problem.alias("problem")).groupBy("file").agg(F.array_sort(F.collect_list(F.struct("ordinal", "problem"))).alias("all"))
    texts = texts.select("file", F.size(F.filter("all", lambda x: x["problem"].rlike("^new [0-9]+$"))).cast("long").alias("n_new"), F.md5(F.array_join(F.transform("all", lambda x: x["problem"]), "\x01")).alias("problems_md5"))
    return texts.join(store.manifest().select("file", (F.col("written") != first).cast("long").alias("generation")), "file")


@query(f"""WITH d AS (SELECT *, doc_id % 5 = 0 AS bare, doc_id % 7 = 0 AS holds FROM documents),
e AS (SELECT doc_id // {MANY} AS file, doc_id, CASE WHEN bare THEN 'inner' ELSE text END AS problem FROM d WHERE NOT bare OR holds)
SELECT file, row_number() OVER (PARTITION BY file ORDER BY doc_id)::BIGINT AS ordinal, md5(problem) AS problem_md5 FROM e""")
def huge_documents(spark, sf_dir: str) -> DataFrame:
    """Files of thousands of exercises, read in ranges about as long as the longest of them."""
    rows = alias_exercises(spark, sf_dir).withColumn("file", F.expr(f"CAST(doc_id DIV {MANY} AS STRING)"))
    longest = rows.agg(F.max(F.octet_length("raw_json"))).scalar()
    path = new_path(spark)
    source.export_files(nested_files(rows).select(F.concat("file", F.lit(".json")).alias("file_name"), "content"), path)
    size = spark.range(1).select(F.greatest(F.lit(1 << 16), longest)).head()[0]
    found = parse_huge_documents(spark, path, range_bytes=size)
    return found.select(F.regexp_extract("file", r"([0-9]+)\.json$", 1).cast("long").alias("file"), "ordinal", F.md5(records.problem_text(F.try_parse_json("raw_json"))).alias("problem_md5"))


@query(f"""SELECT {LOG_SQL} AS ex_id, count(*)::BIGINT AS stopped FROM events WHERE event_type = 'error' GROUP BY 1""")
def stopped_compiles(spark, sf_dir: str) -> DataFrame:
    """Compiles that were stopped, as logs of one error each."""
    e = table(spark, sf_dir, "events").where("event_type = 'error'")
    logs = e.select(log_of().alias("ex_id"), diagnostics.timeout_row(F.concat(F.lit("f"), F.col("event_id").cast("string")), 120).alias("output"))
    found = diagnostics.parse_diagnostics(logs).where("line = 0 AND column = 0 AND severity = 'error' AND message = 'stopped after 120 s'")
    return found.groupBy("ex_id").agg(F.count(F.lit(1)).alias("stopped"))


def model():
    """A model that is a function of its prompt: what it does depends on the exercise's index."""

    def ask(prompt: str) -> dict:
        if prompt.startswith("repair"):
            code = prompt.partition("```lean\n")[2].partition("\n```")[0]
            return {"response": "```lean\n" + (code if "never" in code else code.replace("broken", "mended")) + "\n```", "prompt_tokens": 3, "completion_tokens": 2, "total_tokens": 5, "usage_source": "api"}
        exercise = json.loads(prompt[prompt.index("{") :])
        k = exercise["index"] % 7
        if prompt.startswith("rewrite"):
            if k == 1:
                raise ConnectionError("no answer")
            if k == 5 and "Field 'problem' must remain a string." not in prompt:
                return {"response": '{"problem": 1}'}
            return {"response": json.dumps({"problem": "Goal: " + exercise["problem"]})}
        said = {2: "", 3: "broken never", 4: "broken once"}.get(k, "fine")
        return {"response": said and f"```lean\n{said} {len(exercise['problem'])}\n```"}

    return ask


def compiler():
    return lambda name, content: ("", f"{name}:1:0: error: it broke\n", 1) if "broken" in content else ("built\n", "", 0)


def stopping(after: int | None):
    """A model that repeats its prompt, and stops its task with more than an error when it has answered so many."""

    def factory():
        left = [after]

        def ask(prompt: str) -> dict:
            if left[0] == 0:
                raise KeyboardInterrupt("the model is gone")
            left[0] = left[0] and left[0] - 1
            return {"response": f"said {prompt}", "total_tokens": len(prompt)}

        return ask

    return factory


@query("""SELECT doc_id, md5('said ' || coalesce(text, '')) AS response_md5, length(coalesce(text, ''))::BIGINT AS total_tokens, 1::BIGINT AS n_calls FROM documents""")
def call_ledger(spark, sf_dir: str) -> DataFrame:
    """All documents' prompts through a model that stops its tasks midway, then through one that doesn't: how often the ledger
    has each prompt's call."""
    prompts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ex_id"), F.lit(1).alias("attempt"), F.coalesce("text", F.lit("")).alias("prompt"))
    book = CallLedger(spark, new_path(spark), every=8)
    with suppress(PythonException):
        book.respond(prompts, stopping(20), "rewrite")
    said = book.respond(prompts, stopping(None), "rewrite")
    n_calls = book.records().groupBy(F.md5("response").alias("response_md5")).agg(F.count(F.lit(1)).alias("n_calls"))
    return said.select(F.col("ex_id").alias("doc_id"), F.md5("response").alias("response_md5"), "total_tokens").join(n_calls, "response_md5")


RUN = """SELECT doc_id, CASE k WHEN 2 THEN 'error' WHEN 3 THEN 'repair_failed' ELSE 'valid' END AS status, CASE k WHEN 3 THEN 2 WHEN 4 THEN 1 ELSE 0 END AS repair_attempts,
  CASE k WHEN 2 THEN NULL WHEN 3 THEN 'broken never ' WHEN 4 THEN 'mended once ' ELSE 'fine ' END || n AS code, md5(p) AS problem_md5 FROM (
  SELECT *, length(p) AS n FROM (SELECT doc_id, doc_id % 7 AS k, CASE WHEN doc_id % 7 = 1 THEN coalesce(text, '') ELSE 'Goal: ' || coalesce(text, '') END AS p FROM documents))"""


def corpus_run(spark, sf_dir: str) -> dict[str, DataFrame]:
    """All documents rewritten, translated, compiled and repaired."""
    spark = in_small_batches(spark)
    one = F.to_json(F.struct(F.col("doc_id").alias("index"), F.coalesce("text", F.lit("")).alias("problem"), F.lit("").alias("proof")))
    files = table(spark, sf_dir, "documents").groupBy(F.expr(FILE).alias("file")).agg(F.concat(F.lit("["), F.array_join(F.collect_list(one), ","), F.lit("]")).alias("content"))
    run = CorpusRun(model, compiler, lambda df, name: materialise(df, compact=True), {k: k for k in ("rewrite", "translate", "repair")}, rewrites=2, translations=2, repairs=2)
    return run(files)


@query(RUN)
def full_run(spark, sf_dir: str) -> DataFrame:
    done = corpus_run(spark, sf_dir)["exercises"]
    return done.select(F.get_json_object("raw_json", "$.index").cast("long").alias("doc_id"), "status", F.col("repair_attempts").cast("int"), "code", F.md5("problem").alias("problem_md5"))


@query(f"""WITH r AS (SELECT status, count(*) AS n FROM ({RUN}) GROUP BY 1), d AS (SELECT doc_id % 7 AS k, count(*) AS n FROM documents GROUP BY 1)
SELECT 'rewrite' AS call_type, sum(CASE WHEN k IN (1, 5) THEN 2 * n ELSE n END)::BIGINT AS n_calls, sum(CASE WHEN k = 1 THEN 2 * n ELSE 0 END)::BIGINT AS failed FROM d UNION ALL
SELECT 'translate', sum(CASE WHEN k = 2 THEN 2 * n ELSE n END)::BIGINT, 0::BIGINT FROM d UNION ALL
SELECT 'repair', sum(CASE k WHEN 3 THEN 2 * n WHEN 4 THEN n ELSE 0 END)::BIGINT, 0::BIGINT FROM d""")
def run_calls(spark, sf_dir: str) -> DataFrame:
    made = corpus_run(spark, sf_dir)["calls"]
    return made.groupBy("call_type").agg(F.count(F.lit(1)).alias("n_calls"), F.count_if(F.col("error").isNotNull()).alias("failed"))
