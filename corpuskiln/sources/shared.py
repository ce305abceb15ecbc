"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset and all tasks run on this
    machine (a local master, as in tests), a fresh temporary one; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="corpuskiln-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


#: Paths that new_path has given out inside each scratch that this thread has open.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("open", default=())


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


@contextmanager
def scratch(spark: SparkSession):
    """What this thread writes inside to paths of ``new_path`` is removed at the end, but for what is to outlive it."""
    own: list[str] = []
    before = _open.set((*_open.get(), own))
    try:
        yield
    finally:
        _open.reset(before)
        for path in own:
            fs, p = _file_system(spark, path)
            fs.delete(p, True)


def read_in_ranges(spark: SparkSession, size: int) -> SparkSession:
    """A session like this one that reads files in byte ranges of this size, whatever their number and the cores."""
    reader = spark.newSession()
    for name in ("maxPartitionBytes", "openCostInBytes"):  # the latter is the least size of a range
        reader.conf.set(f"spark.sql.files.{name}", size)
    return reader


#: Bytes of an Arrow batch of wide rows, such as whole files: several workers of a task each hold some copies of one.
BATCH_BYTES = 4 << 20


def in_small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> SparkSession:
    """A session like this one, with its settings, that gives Python workers Arrow batches of about this size at most; a larger
    row is a batch of its own."""
    reader = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            reader.conf.set(name, value)
    reader.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return reader


def new_path(spark: SparkSession, outlive: bool = False) -> str:
    """A path in the shared folder. What is there goes with the scratch it was asked in (with ``outlive``: with the one
    around that), else with the driver."""
    path = f"{shared_dir(spark)}/corpuskiln/{uuid.uuid4().hex}"
    now = _open.get()
    around = now[: len(now) - outlive]
    if around:
        around[-1].append(path)
    else:
        fs, p = _file_system(spark, path)
        fs.deleteOnExit(p)
    return path


#: Set while a table is written: its shuffles' files go with the write, not whenever the driver collects its garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, outlive: bool = False, session: SparkSession | None = None, compact: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, sizes are known, lost executors cost nothing.
    session: the one to read it in, if not df's own. compact: for texts that stay long, as small as they get on disk, with the
    files of the shuffles behind them gone."""
    spark, path = df.sparkSession, new_path(df.sparkSession, outlive)
    before = spark.conf.get(CLEAN_UP, "false")
    try:
        if compact:
            spark.conf.set(CLEAN_UP, "true")
        (df.write.option("compression", "zstd") if compact else df.write).parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return (session or spark).read.schema(df.schema).parquet(path)
