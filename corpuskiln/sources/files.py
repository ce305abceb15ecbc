"""Files of given names, written by tasks in two phases, through file systems that tasks reach themselves."""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

#: Where tasks put files before they count; Spark's readers skip such names.
STAGING = "_staging"
#: Files that are moved at once when an export is committed.
MOVERS = 16


def file_system(path: str):
    """(file system, path in it) of a path or URI: local or mounted folders, and what pyarrow knows (s3, gs, hdfs, abfs)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri("/" + path[5:].lstrip("/") if path.startswith("file:") else path)


def put(files, path: str, content: bytes) -> None:
    """A whole file or none under this name: written beside it first."""
    folder, _, name = path.rpartition("/")
    aside = f"{folder}/.{uuid.uuid4().hex}"
    with files.open_output_stream(aside) as out:
        out.write(content)
    files.move(aside, path)


def entries(files, folder: str) -> list:
    from pyarrow import fs

    return files.get_file_info(fs.FileSelector(folder, allow_not_found=True))


class Staged(WriterCommitMessage):
    def __init__(self, folder: str):
        self.folder = folder


class _Writer(DataSourceArrowWriter):
    """First phase: each attempt of a task fills a folder of its own. Second phase: a manifest names the folders of the
    attempts that count, and their files are moved to where they belong; who finds a manifest can finish that."""

    def __init__(self, path: str, alone: bool):
        self.path, self.alone, self.run = path.rstrip("/"), alone, uuid.uuid4().hex

    def write(self, iterator):
        files, root = file_system(self.path)
        folder = f"{root}/{STAGING}/{self.run}/{uuid.uuid4().hex}"
        files.create_dir(folder, recursive=True)
        names: set[str] = set()
        for batch in iterator:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not name or name in (".", "..") or "/" in name or name in names:
                    raise ValueError(f"no file can be named {name!r}" if name not in names else f"two files are named {name!r}")
                names.add(name)
                with files.open_output_stream(f"{folder}/{name}") as out:
                    out.write((content or "").encode("utf-8", "surrogatepass"))
        return Staged(folder)

    def commit(self, messages):
        files, root = file_system(self.path)
        staged = [m.folder for m in messages if m]
        if staged:
            put(files, f"{root}/{STAGING}/{self.run}/_manifest", json.dumps({"folders": staged, "alone": self.alone}).encode())
        finish_exports(self.path)

    def abort(self, messages):
        files, root = file_system(self.path)
        if entries(files, f"{root}/{STAGING}/{self.run}"):
            files.delete_dir(f"{root}/{STAGING}/{self.run}")


class NamedFiles(DataSource):
    """(file_name, content) as files of these names and exactly this content. Options: path, alone."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema, overwrite):
        return _Writer(self.options["path"], self.options.get("alone") == "true")


def finish_exports(path: str) -> None:
    """Moves what committed exports have left in their staging folders; doing so again, or after a stop midway, is safe."""
    files, root = file_system(path.rstrip("/"))
    for run in entries(files, f"{root}/{STAGING}"):
        if not any(e.base_name == "_manifest" for e in entries(files, run.path)):
            continue  # still being written, or given up
        with files.open_input_stream(f"{run.path}/_manifest") as f:
            manifest = json.loads(f.read())
        moved = [e for folder in manifest["folders"] for e in entries(files, folder)]
        if manifest["alone"]:  # files of other names go when all new ones are there; the manifest remembers their names
            names = manifest.setdefault("names", [e.base_name for e in moved])
            put(files, f"{run.path}/_manifest", json.dumps(manifest).encode())
        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(lambda e: files.move(e.path, f"{root}/{e.base_name}"), moved))
        if manifest["alone"]:
            keep = set(names)
            for e in entries(files, root):
                if e.is_file and e.base_name not in keep:
                    files.delete_file(e.path)
        files.delete_dir(run.path)


def export_files(files: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """(file_name, content), a file of that name for each row under path, holding the content and nothing else.

    Names must be resolved: a name twice, an empty one or one with a slash ends the export, and nothing of it stays. mode:
    'errorifexists', 'append' (files of these names are replaced) or 'overwrite' (and all others removed). A failed or repeated
    task leaves no file; a stop while files are moved is made good by the next export or ``finish_exports``. Each file costs
    its task one write and the commit one move."""
    fs, root = file_system(path.rstrip("/"))
    finish_exports(path)
    if mode == "errorifexists" and any(e.base_name != STAGING for e in entries(fs, root)):
        raise FileExistsError(path)
    if mode not in ("errorifexists", "append", "overwrite"):
        raise ValueError(f"no such mode: {mode}")
    files.sparkSession.dataSource.register(NamedFiles)
    rows = files.select(F.col("file_name").cast("string"), F.coalesce(F.col("content").cast("string"), F.lit("")).alias("content")).repartition("file_name")
    rows.write.format("named_files").option("path", path).option("alone", str(mode == "overwrite").lower()).mode("append").save()


def read_exported(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, content) of the files under path, but for empty ones, which Spark's readers pass over."""
    return spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("content").cast("string"))
