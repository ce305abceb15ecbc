"""A ledger of calls to a model: what has been asked and answered is never asked again."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.sources.files import entries, file_system

ANSWER = "response string, prompt_tokens long, completion_tokens long, total_tokens long, usage_source string, error string"
CALL = f"call string, stage string, attempt int, {ANSWER}, asked_at long, part string"
#: Calls of a part: what a task that is killed may have to ask again.
EVERY = 16
#: Tasks of a run ask nothing more once its folder has a file of this name; Spark's readers skip it.
ENDED = "_ended"
#: Seconds between two looks at whether a run's tasks have ended.
LOOK = 0.1


class CallLedger:
    """Calls by content: the SHA-256 of stage, attempt and prompt is a call's address.

    Tasks write their calls down in small parts, each a file that is there as a whole or not at all, after every ``every`` calls
    and when they end, for whatever reason. Calls that are in the ledger when ``respond`` begins are left out by an anti-join;
    a task that is tried again reads what its earlier attempts wrote. So one that ends with an error repeats no call, and a
    killed one at most the last ``every`` - 1. Rows with equal prompts share a call. When ``respond`` ends, also by an error,
    its tasks have ended: Spark fails a job while others of its tasks still ask, and what those write down later the next
    ``respond`` wouldn't find. The path must be one that tasks reach (see ``sources.files``)."""

    def __init__(self, spark: SparkSession, path: str, every: int = EVERY):
        self.spark, self.path, self.every = spark, path.rstrip("/"), every
        files, root = file_system(self.path)
        files.create_dir(root, recursive=True)

    def records(self) -> DataFrame:
        """All that was written down; a call that two tasks made at once is there twice."""
        return self.spark.read.schema(CALL).option("recursiveFileLookup", True).parquet(self.path)

    def calls(self) -> DataFrame:
        """A row a call: the first of its records."""
        kept = F.min_by(F.struct(*[c for c in self.records().columns if c != "call"]), F.struct("asked_at", "part"))
        return self.records().groupBy("call").agg(kept.alias("first")).select("call", "first.*").drop("asked_at", "part")

    def respond(self, prompts: DataFrame, factory: Callable[[], Callable[[str], dict]], stage: str, key: str = "ex_id") -> DataFrame:
        """As ``attempts.respond``, each different prompt of an attempt asked once. It asks when it is called."""
        address = F.sha2(F.concat_ws("\n", F.lit(stage), F.col("attempt").cast("string"), "prompt"), 256)
        asked = prompts.select(key, F.col("attempt").cast("int"), "prompt", address.alias("call"))
        known = self.records().where(F.col("stage") == stage).select("call").distinct()
        due = asked.select("call", "attempt", "prompt").dropDuplicates(["call"]).join(known, "call", "left_anti")
        run = f"{self.path}/{uuid.uuid4().hex}"
        with _outlived(self.spark, run):
            due.mapInArrow(_asking(run, factory, stage, self.every), "n long").agg(F.sum("n")).collect()  # one number
        return asked.drop("prompt").join(self.calls().drop("attempt"), "call").drop("call")

    def compact(self) -> None:
        """Parts brought together in few files. A stop midway leaves records twice, which calls() allows for."""
        files, root = file_system(self.path)
        before = [e.path for e in entries(files, root)]
        new = f"{self.path}/{uuid.uuid4().hex}"
        kept = F.min_by(F.struct("*"), F.struct("asked_at", "part"))
        self.records().groupBy("call").agg(kept.alias("first")).select("first.*").write.parquet(new)
        for old in before:
            files.delete_dir(old)


@contextmanager
def _outlived(spark: SparkSession, run: str):
    """Ends when all tasks of the jobs begun inside have: the ones of a failed job, and copies of one task, go on for a while.
    They begin no further call by then, even where a worker outlives its task."""
    context, name = spark.sparkContext, "spark.jobGroup.id"
    before, tracker = context.getLocalProperty(name), context.statusTracker()
    context.setLocalProperty(name, run)
    try:
        yield
    finally:
        context.setLocalProperty(name, before)
        files, root = file_system(run)
        files.create_dir(root, recursive=True)
        files.open_output_stream(f"{root}/{ENDED}").close()
        for job in tracker.getJobIdsForGroup(run):
            # the end of a job is told after the begin of its tasks, and its stages' last end is always told
            while (told := tracker.getJobInfo(job)) and (told.status == "RUNNING" or any(s.numActiveTasks for s in map(tracker.getStageInfo, told.stageIds) if s)):
                time.sleep(LOOK)


def _asking(path: str, factory: Callable, stage: str, every: int) -> Callable:
    import pyarrow as pa
    from pyarrow.fs import FileType

    def run(batches):
        import pyarrow.parquet as pq

        files, root = file_system(path)
        folder = f"{root}/{TaskContext.get().partitionId()}"
        files.create_dir(folder, recursive=True)
        done = set()
        for e in entries(files, folder):  # of this task's earlier attempts
            if not e.base_name.startswith("."):
                with files.open_input_file(e.path) as f:
                    done.update(pq.read_table(f, columns=["call"]).column(0).to_pylist())
        ask, waiting, n = factory(), [], 0

        def write_down():
            if waiting:
                part = f"{uuid.uuid4().hex}.parquet"
                table = pa.Table.from_pylist([w | {"part": part} for w in waiting], schema)
                with files.open_output_stream(f"{folder}/.{part}") as out:
                    pq.write_table(table, out)
                files.move(f"{folder}/.{part}", f"{folder}/{part}")
                waiting.clear()

        schema = pa.schema([(c, {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[k]) for c, k in (x.split() for x in CALL.split(", "))])
        empty = {"response": None, "prompt_tokens": 0, "completion_tokens": 0, "total_tokens": 0, "usage_source": "none", "error": None}
        try:
            for b in batches:
                for call, attempt, prompt in zip(*[c.to_pylist() for c in b.columns]):
                    if call in done:
                        continue
                    if files.get_file_info(f"{root}/{ENDED}").type != FileType.NotFound:
                        raise RuntimeError("this run has ended")
                    try:
                        said = {k: v for k, v in ask(prompt).items() if k in empty and v is not None}
                    except Exception as e:  # noqa: BLE001  the caller's model may raise anything
                        said = {"error": f"{type(e).__name__}: {e}"}
                    waiting.append(empty | said | {"call": call, "stage": stage, "attempt": attempt, "asked_at": time.time_ns()})
                    n += 1
                    if len(waiting) >= every:
                        write_down()
        finally:
            write_down()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return run
