"""Documents in generations: a write-back adds the changed ones, and one small file says which generation counts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.sources.files import entries, file_system, put
from corpuskiln.sources.shared import materialise, scratch

CURRENT = "CURRENT"


class Generations:
    """A folder with the contents that each commit changed (contents/<generation>), for each generation a manifest of all
    documents and where their content is (manifests/<generation>), and CURRENT, which names the generation.

    A commit writes the changed contents and the new manifest, then replaces CURRENT by a move. Until then readers see the old
    generation, as they do after a stop midway; what was written is never touched again. Manifests are narrow: unchanged
    documents cost a commit a row each and none of their bytes. Two writers at once are one too many: the second finds that
    CURRENT isn't what it began with, and fails."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def generation(self) -> str | None:
        files, root = file_system(self.path)
        if not any(e.base_name == CURRENT for e in entries(files, root)):
            return None
        with files.open_input_stream(f"{root}/{CURRENT}") as f:
            return f.read().decode()

    def manifest(self, generation: str | None = None) -> DataFrame:
        """(file, written): the generation that wrote each document's content."""
        generation = generation or self.generation()
        if generation is None:
            return self.spark.createDataFrame([], "file string, written string")
        return self.spark.read.schema("file string, written string").parquet(f"{self.path}/manifests/{generation}")

    def documents(self, generation: str | None = None) -> DataFrame:
        """(file, content) of a generation, the current one if none is named. Only the contents that count are joined."""
        listed = self.manifest(generation)
        if generation is None and self.generation() is None:
            return listed.withColumn("content", F.lit(None).cast("string")).drop("written")
        contents = self.spark.read.schema("file string, content string, written string").parquet(f"{self.path}/contents")
        return contents.join(listed, ["file", "written"]).select("file", "content")

    def commit(self, changed: DataFrame, removed: DataFrame | None = None) -> str:
        """changed (file, content), a row a file: the documents that are new or different. removed (file). Returns the name of
        the generation."""
        before, new = self.generation(), f"{uuid.uuid4().hex}"
        files, root = file_system(self.path)
        with scratch(self.spark):
            rows = materialise(changed.select("file", "content"))
            rows.write.parquet(f"{self.path}/contents/written={new}")
            own = rows.select("file", F.lit(new).alias("written"))
            gone = rows.select("file") if removed is None else rows.select("file").unionByName(removed.select("file"))
            self.manifest(before).join(gone.distinct(), "file", "left_anti").unionByName(own).write.parquet(f"{self.path}/manifests/{new}")
        if self.generation() != before:
            raise RuntimeError(f"another writer committed to {self.path} meanwhile")
        put(files, f"{root}/{CURRENT}", new.encode())
        return new
