"""Files of given names, the ledger of calls: whole or not at all, once and not again."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuskiln.operators.ledger import CallLedger
from corpuskiln.plans.workloads import CorpusRun
from corpuskiln.sources import exercises as source
from corpuskiln.sources import files as sink

FILES = "file_name string, content string"


def there(folder):
    return {p.name: p.read_bytes() for p in folder.iterdir() if p.is_file()} if folder.exists() else {}


def test_files_hold_the_code_and_nothing_else(spark, tmp_path):
    out = tmp_path / "out"
    rows = [(f"n{k}.lean", t) for k, t in enumerate(["one\ntwo", "end\n", "", None, "é\r\n", "x" * 3_000_000])]
    source.export_files(spark.createDataFrame(rows, FILES).repartition(3), str(out))
    want = {n: (t or "").encode() for n, t in rows}
    assert there(out) == want and {r.file_name: r.content.encode() for r in source.read_exported(spark, str(out)).collect()} == {n: t for n, t in want.items() if t}
    with pytest.raises(FileExistsError):
        source.export_files(spark.createDataFrame(rows, FILES), str(out))
    source.export_files(spark.createDataFrame([("n0.lean", "new"), ("m.lean", "m")], FILES), f"file:{out}", "append")
    assert there(out) == want | {"n0.lean": b"new", "m.lean": b"m"}
    source.export_files(spark.createDataFrame([("n1.lean", "1"), ("o.lean", "o")], FILES), str(out), "overwrite")
    assert there(out) == {"n1.lean": b"1", "o.lean": b"o"} and not list((out / sink.STAGING).iterdir())
    source.export_files(spark.createDataFrame([], FILES), str(out), "append")
    assert len(there(out)) == 2


@pytest.mark.parametrize("bad", ["a/b", "", "..", "good0"])
def test_a_failed_export_leaves_nothing(spark, tmp_path, bad):
    out = tmp_path / "out"
    rows = [(f"good{k}", "x") for k in range(20)] + [(bad, "y")]
    with pytest.raises(Exception):
        source.export_files(spark.createDataFrame(rows, FILES), str(out))
    assert there(out) == {} and not [p for p in out.rglob("*") if p.is_file()]


def test_repeated_attempts_and_a_stop_midway(tmp_path, monkeypatch):
    out = tmp_path / "out"
    writer = sink._Writer(str(out), False)
    batch = lambda *rows: pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], ["file_name", "content"])

    def cut():
        yield batch(("a", "half"))
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        writer.write(cut())  # killed
    writer.write(iter([batch(("a", "lost"))]))  # an attempt that doesn't count
    messages = [writer.write(iter([batch(("a", "one"), ("b", "two"))])), writer.write(iter([batch(("c", "three"))]))]
    assert there(out) == {}
    move, n = sink.file_system, []

    class Stopping:
        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def move(self, a, b):
            n.append(b)
            if len(n) == 3:  # the manifest, one file, then the end
                raise OSError("gone")
            self.inner.move(a, b)

    monkeypatch.setattr(sink, "file_system", lambda p: (Stopping(move(p)[0]), move(p)[1]))
    monkeypatch.setattr(sink, "MOVERS", 1)
    with pytest.raises(OSError):
        writer.commit(messages)
    monkeypatch.setattr(sink, "file_system", move)
    sink.finish_exports(str(out))
    assert there(out) == {"a": b"one", "b": b"two", "c": b"three"}
    sink.finish_exports(str(out))


class Model:
    """Writes each prompt it is asked into a file; ends its task with more than an error after so many."""

    def __init__(self, log, stop=None):
        self.log, self.stop = log, stop

    def __call__(self):
        left = [self.stop]

        def ask(prompt):
            if left[0] == 0:
                raise KeyboardInterrupt("gone")
            left[0] = left[0] and left[0] - 1
            with open(f"{self.log}/{os.getpid()}", "a") as f:
                f.write(prompt + "\n")
            if prompt == "p13":
                raise ValueError("no")
            return {"response": prompt.upper(), "total_tokens": 3, "usage_source": None}

        return ask


def asked(log):
    return sorted(x for p in log.iterdir() for x in p.read_text().splitlines())


@pytest.mark.parametrize("every", [1, 3, 1000])
def test_a_call_is_made_once(spark, tmp_path, every):
    log = tmp_path / "log"
    log.mkdir()
    rows = [(k, 1, f"p{k % 40}") for k in range(60)] + [(60 + k, 1, "hot") for k in range(50)] + [(200, 2, "p0"), (None, 1, "p1")]
    prompts = spark.createDataFrame(rows, "ex_id long, attempt int, prompt string").repartition(4)
    book = CallLedger(spark, str(tmp_path / "book"), every)
    with pytest.raises(Exception):
        book.respond(prompts, Model(str(log), 4), "rewrite")
    assert 0 < len(asked(log)) < 41
    for _ in range(2):
        got = book.respond(prompts, Model(str(log)), "rewrite").collect()
        assert asked(log) == sorted([*(f"p{k}" for k in range(40)), "hot", "p0"])
        assert len(got) == len(rows) and sorted(got[0].asDict()) == sorted("ex_id attempt response prompt_tokens completion_tokens total_tokens usage_source error stage".split())
        assert all(r.response == (None if r.error else dict((a, c) for a, _, c in rows)[r.ex_id].upper()) for r in got)
        assert [(r.error, r.usage_source, r.total_tokens) for r in got if r.ex_id in (13, 53)] == [("ValueError: no", "none", 0)] * 2
        book.compact()
    assert book.records().count() == 42 and len(book.respond(prompts, Model(str(log)), "translate").collect()) == len(rows)
    assert len(asked(log)) == 84 and book.respond(prompts.limit(0), Model(str(log)), "rewrite").count() == 0


def test_a_task_that_is_tried_again_reads_its_earlier_parts(tmp_path, monkeypatch):
    from corpuskiln.operators import ledger

    log = tmp_path / "log"
    log.mkdir()
    monkeypatch.setattr(ledger, "TaskContext", type("C", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": staticmethod(lambda: 3)}))}))
    batch = pa.RecordBatch.from_arrays([pa.array([str(k) for k in range(10)]), pa.array([1] * 10, pa.int32()), pa.array([f"q{k}" for k in range(10)])], ["call", "attempt", "prompt"])
    with pytest.raises(KeyboardInterrupt):
        list(ledger._asking(str(tmp_path / "run"), Model(str(log), 6), "s", 4)(iter([batch])))
    assert sum(b.column(0)[0].as_py() for b in ledger._asking(str(tmp_path / "run"), Model(str(log)), "s", 4)(iter([batch]))) == 4
    assert asked(log) == [f"q{k}" for k in range(10)]


def test_a_failed_run_asks_nothing_after_its_end(spark, tmp_path, request):
    """One task fails at once, while the others have calls left to make."""
    import time

    few = "spark.sql.adaptive.coalescePartitions.enabled"  # small as they are, four tasks
    spark.conf.set(few, "false")
    request.addfinalizer(lambda: spark.conf.unset(few))
    log = tmp_path / "log"
    log.mkdir()

    def factory():
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() == 0

        def ask(prompt):
            time.sleep(1 if first else 0.05)
            if first:
                raise KeyboardInterrupt("gone")
            with open(f"{log}/{os.getpid()}", "a") as f:
                f.write(prompt + "\n")
            return {"response": prompt}

        return ask

    prompts = spark.createDataFrame([(k, 1, f"p{k}") for k in range(400)], "ex_id long, attempt int, prompt string")
    book = CallLedger(spark, str(tmp_path / "book"), 1)
    with pytest.raises(Exception):
        book.respond(prompts, factory, "rewrite")
    n, written = len(asked(log)), book.records().count()
    assert 0 < n < 300 and n - written <= 4  # a call of each killed task at most is lost
    time.sleep(3)
    assert len(asked(log)) == n and book.records().count() == written
    assert book.respond(prompts, Model(str(log)), "rewrite").count() == 400
    assert book.records().groupBy("call").count().where("count > 1").isEmpty()


def test_a_run_keeps_each_text_once(spark, tmp_path):
    """What a run stores: exercises as found and answers, whatever the number of rounds and stages."""
    import json

    from test_operators import compiler

    text, kept = [os.urandom(20_000).hex() for _ in range(20)], {}

    def model():
        def ask(prompt):
            if prompt.startswith("rewrite"):
                return {"response": json.dumps({"problem": "Goal: " + json.loads(prompt[prompt.index("{") :])["problem"]})}
            return {"response": "```lean\nfine\n```"}

        return ask

    def keep(df, name):
        df.write.parquet(str(tmp_path / name))
        kept[name] = sum(p.stat().st_size for p in (tmp_path / name).glob("*.parquet"))
        return spark.read.parquet(str(tmp_path / name))

    documents = spark.createDataFrame([("f", json.dumps([{"problem": t, "proof": "", "source_idx": k + 1} for k, t in enumerate(text)]))], "file string, content string")
    out = CorpusRun(model, compiler, keep, {x: x for x in ("rewrite", "translate", "repair")})(documents)
    assert sum(kept.values()) < 2.5 * sum(map(len, text))
    rows = {r.label: r for r in out["exercises"].collect()}
    assert all(rows[str(k + 1)].problem == "Goal: " + t == json.loads(rows[str(k + 1)].raw_json)["problem"] and rows[str(k + 1)].status == "valid" for k, t in enumerate(text))
    assert out["exercises"].columns == "ex_id file ordinal raw_json label problem file_name repair_attempts code is_valid n_errors n_warnings status".split()


def test_a_run_begun_anew_asks_nothing_again(spark, tmp_path):
    import json

    from test_operators import compiler

    log = tmp_path / "log"
    log.mkdir()

    def model():
        def ask(prompt):
            with open(f"{log}/{os.getpid()}", "a") as f:
                f.write(prompt.split()[0] + "\n")
            return {"response": json.dumps({"problem": "Goal: x"}) if prompt.startswith("rewrite") else "```lean\nfine\n```"}

        return ask

    documents = spark.createDataFrame([("f", json.dumps([{"problem": f"p{k}", "proof": "", "source_idx": k} for k in range(5)]))], "file string, content string")
    book = CallLedger(spark, str(tmp_path / "book"))
    for k in range(2):
        def keep(df, name, k=k):
            df.write.parquet(str(tmp_path / f"{k}" / name))
            return spark.read.parquet(str(tmp_path / f"{k}" / name))

        out = CorpusRun(model, compiler, keep, {x: x for x in ("rewrite", "translate", "repair")}, ledger=book)(documents)
        assert out["exercises"].where(F.col("status") == "valid").count() == 5 and out["calls"].count() == 10
    # rewritten exercises differ by their source_idx alone, so there are five prompts of each stage
    assert asked(log) == ["rewrite"] * 5 + ["translate"] * 5


def test_a_session_with_small_batches(spark):
    """The settings of the session it is made from, also those set at run time, and batches by bytes."""
    from corpuskiln.plans.queries import QUERIES
    from corpuskiln.sources.shared import in_small_batches

    small = in_small_batches(spark, 1 << 20)
    assert small.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions") == "4"

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    found = [r.n for r in small.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("t")).mapInArrow(sizes, "n long").collect()]
    assert sum(found) > 19_000_000 and max(found) < 3_000_000
    query = QUERIES["write_back"](spark, "/root/testdata/sf0.001").sparkSession
    assert int(query.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 4 << 20
