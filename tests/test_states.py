"""Counts taken on the way, keyed state over restarts, generations of documents."""

import os

import pytest
from pyspark.sql import functions as F

from corpuskiln.operators import outputs, reports
from corpuskiln.sources.generations import CURRENT, Generations
from corpuskiln.streaming.incremental import first_names, last_names, latest

ROWS = "file_name string, seq int, code string"


def test_counts_in_the_writing_pass(spark, tmp_path):
    scans = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            scans.add(b.num_rows)
            yield b

    rows = spark.createDataFrame([(k % 3 == 0, k, None, 2 * k) for k in range(100)], "ok boolean, prompt_tokens long, completion_tokens long, total_tokens long")
    read = rows.mapInArrow(passed, rows.schema)
    found = reports.write_counted(read, str(tmp_path / "out"), **reports.conversion_aggregates(F.col("ok")), **reports.token_aggregates())
    assert found == {"written": 34, "failed": 66, "prompt_tokens": 4950, "completion_tokens": 0, "total_tokens": 9900} and scans.value == 100
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100
    assert reports.write_counted(rows.limit(0), str(tmp_path / "none"), **reports.conversion_aggregates(F.col("ok"))) == {"written": 0, "failed": 0}


def test_names_over_batches_and_restarts(spark, tmp_path):
    batches = [[("a", 5, "a5"), ("a", 3, "a3"), ("b", 1, "b1"), (None, 1, "n")], [("a", 1, "a1"), ("a", 9, "a9"), ("c", 2, "c2"), (None, 2, "m")], [("b", 0, "b0"), ("d", 1, "d1")]]
    inbox = str(tmp_path / "in")
    for rows in batches:
        spark.createDataFrame(rows, ROWS).write.mode("append").parquet(inbox)
        for _ in range(2):  # a run that finds nothing new changes nothing
            for names in (first_names, last_names):
                stream = spark.readStream.schema(ROWS).parquet(inbox)
                names(stream, str(tmp_path / names.__name__), str(tmp_path / f"{names.__name__}-marks")).awaitTermination(120)
    first = spark.read.parquet(str(tmp_path / "first_names"))
    assert {r.file_name: r.code for r in first.collect()} == {"a": "a3", "b": "b1", None: "n", "c": "c2", "d": "d1"} and first.count() == 5
    last = latest(spark.read.parquet(str(tmp_path / "last_names")))
    assert {r.file_name: (r.code, r.same_name) for r in last.collect()} == {"a": ("a9", 4), "b": ("b1", 2), None: ("m", 2), "c": ("c2", 1), "d": ("d1", 1)}


def held(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, files in os.walk(path) for f in files if not f.startswith(".") and f != CURRENT}


def test_generations(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    store = Generations(spark, path)
    assert store.generation() is None and store.documents().collect() == []
    one = '[{"problem": "%s", "proof": ""}]'
    docs = spark.createDataFrame([(f"d/{k}", one % k) for k in range(6)] + [("broken", "{")], "file string, content string")
    first = store.commit(docs)
    before = held(path)
    changes = spark.createDataFrame([("d/1", 1, "new"), ("d/4", 1, "4 again"), ("broken", 1, "x"), ("d/2", 9, "no such place"), ("lost", 1, "x")], "file string, ordinal long, problem string")
    second = outputs.write_back_changes(store, changes)
    want = {r.file: r.content for r in docs.collect()} | {"d/1": one % "new", "d/4": one % "4 again"}
    assert {r.file: r.content for r in store.documents().collect()} == want and store.generation() == second
    after = held(path)
    assert {p: t for p, t in after.items() if p in before} == before  # nothing that lay there was touched
    assert {r.file for r in store.manifest().where(F.col("written") == second).collect()} == {"d/1", "d/4"}
    assert {r.file: r.content for r in store.documents(first).collect()}["d/1"] == one % 1

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr("corpuskiln.sources.generations.put", stop)
        with pytest.raises(KeyboardInterrupt):
            store.commit(docs.where("file = 'd/0'").withColumn("content", F.lit("[]")))
    assert {r.file: r.content for r in store.documents().collect()} == want
    store.commit(docs.limit(0), docs.where("file = 'broken'").select("file"))
    assert {r.file for r in store.documents().collect()} == set(want) - {"broken"}

    generation = iter([second, "another"])
    monkeypatch.setattr(store, "generation", lambda: next(generation))
    with pytest.raises(RuntimeError):
        store.commit(docs.limit(0))
