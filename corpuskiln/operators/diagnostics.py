"""Compiler logs to diagnostics, joined to the source lines they point at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuskiln.functions.text import LINE_END, char_at, split_lines, strip_ws
from corpuskiln.operators.joins import dealt
from corpuskiln.sources.shared import read_in_ranges

#: What stands for a source line that isn't there.
NO_FILE, NO_LINE = "[couldn't read file {}]", "[couldn't read line {}]"


def joined_log(stdout: Column, stderr: Column) -> Column:
    return F.concat(F.coalesce(stdout, F.lit("")), F.lit("\n"), F.coalesce(stderr, F.lit("")))


def timeout_row(file: Column, seconds: int) -> Column:
    """The log of a compile that was stopped: one error at 0:0."""
    return F.concat(file, F.lit(f":0:0: error: stopped after {seconds} s"))


#: Line and column numbers beyond this count as this.
MOST = (1 << 31) - 1


def _header(line: Column, severity: str) -> Column:
    group = lambda k: F.regexp_extract(line, rf"^(.+):(\d+):(\d+): {severity}: (.+)", k)
    number = lambda k: F.least(F.coalesce(group(k).try_cast("long"), F.lit(MOST)), F.lit(MOST)).cast("int")
    near = F.contains(line, F.lit(f": {severity}: "))  # most lines are done with here
    return F.when(near & (group(2) != ""), F.struct(F.lit(severity).alias("severity"), strip_ws(group(1)).alias("file"), number(2).alias("line"), number(3).alias("column"), strip_ws(group(4)).alias("message")))


def parse_diagnostics(logs: DataFrame, key: str = "ex_id", log: str = "output") -> DataFrame:
    """(key, log) to (key, seq, severity, file, line, column, message), seq from 1 over both severities of a log.

    A header line starts a diagnostic and the lines after it belong to it; what stands before the first is dropped. Each
    row is a log of its own, taken apart where it is: nothing is shuffled, and rows of a null key don't mix.
    """
    lines = logs.select(key, split_lines(F.col(log)).alias("lines"))
    marked = lines.select(key, F.transform("lines", lambda x: F.struct(x.alias("text"), F.coalesce(_header(x, "warning"), _header(x, "error")).alias("head"))).alias("marked"))
    starts = marked.withColumn("at", F.filter(F.transform("marked", lambda m, i: F.when(m["head"].isNotNull(), i)), lambda i: i.isNotNull()))
    each = starts.select(key, "marked", "at", F.posexplode("at").alias("nth", "start"))
    end = F.coalesce(F.get("at", F.col("nth") + 1), F.size("marked"))
    found = each.select(key, (F.col("nth") + 1).alias("seq"), F.get("marked", F.col("start"))["head"].alias("head"), F.slice("marked", F.col("start") + 2, end - F.col("start") - 1).alias("rest"))
    rest = F.array_join(F.transform("rest", lambda m: strip_ws(m["text"])), "\n")
    message = F.when(F.size("rest") > 0, F.concat("head.message", F.lit("\n"), rest)).otherwise(F.col("head.message"))
    return found.select(key, F.col("seq").cast("long").alias("seq"), "head.severity", "head.file", "head.line", "head.column", message.alias("message"))


def _filled(pattern: str, value: Column) -> Column:
    before, _, after = pattern.partition("{}")
    return F.concat(F.lit(before), value, F.lit(after))


#: Lines of a file that are asked for together.
BLOCK_LINES = 512


def with_source_context(diagnostics: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds line_content and char_at_column from sources (file, content, one row per file).

    A file meets the numbers of its own lines that diagnostics point at, BLOCK_LINES of them a row at most, and only those lines
    go on to the diagnostics. The diagnostics of one line are dealt to many tasks, so a file that a third of them name is no
    task's alone; a line goes to each of those that have any, so at most as often as it is in the result."""
    pointing = dealt(diagnostics, F.xxhash64(*diagnostics.columns))
    asked = pointing.groupBy("file", F.expr(f"greatest(0, line - 1) DIV {BLOCK_LINES}").alias("__block")).agg(F.collect_set(F.struct("line", "__salt")).alias("__asked"))
    lines = sources.select("file", split_lines(F.coalesce("content", F.lit(""))).alias("__lines"))
    found = F.transform("__asked", lambda a: F.struct(a["line"].alias("line"), a["__salt"].alias("__salt"), F.get("__lines", a["line"] - 1).alias("__line")))
    sent = asked.join(lines, "file").select("file", F.lit(True).alias("__known"), F.inline(found))
    joined = pointing.join(sent, ["file", "line", "__salt"], "left")
    missing = F.when(F.col("__known"), _filled(NO_LINE, F.col("line").cast("string"))).otherwise(_filled(NO_FILE, F.col("file")))
    here = F.when(F.col("__line").isNotNull(), char_at(F.col("__line"), F.col("column"))).otherwise("")
    return joined.select(*diagnostics.columns, F.coalesce("__line", missing).alias("line_content"), here.alias("char_at_column"))


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, nth, at, text) of text files of any size, read in byte ranges: a block is where a range begins, nth orders
    its lines, and at the parts of one that other line ends than line feeds separate."""
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"), "value")
    return rows.select("file", "block", "nth", F.posexplode(F.split("value", LINE_END, -1)).alias("at", "text"))


def parse_log_files(spark: SparkSession, path: str, range_bytes: int = 64 << 20) -> DataFrame:
    """(file, seq, severity, named, line, column, message) of log files larger than a row or a task, as ``parse_diagnostics``
    gives of a row; named is the file that a diagnostic names.

    Each byte range counts its own headers; running totals over ranges, a row each, number them through the file. Lines before a
    range's first header belong to the last diagnostic of the ranges before: they have its number, and meet it in a group-by.
    A last line that ends with another line end than a line feed has an empty line after it."""
    import numpy as np
    import pyarrow as pa

    lines = log_lines(read_in_ranges(spark, range_bytes), path)
    marked = lines.select("file", "block", "nth", "at", "text", F.coalesce(_header(F.col("text"), "warning"), _header(F.col("text"), "error")).alias("head"))

    def counted(batches):
        """Headers up to each line, in its own range; a task reads its ranges one after the other, in order."""
        own, n = None, 0
        for b in batches:
            files, blocks = b.column(0).to_pylist(), b.column(1).to_numpy()
            new = np.append(True, np.array([f != g for f, g in zip(files, files[1:])], bool) | (blocks[1:] != blocks[:-1])) if files else np.zeros(0, bool)
            first = np.flatnonzero(new)
            up = np.cumsum(b.column(5).is_valid().to_numpy(zero_copy_only=False).astype(np.int64))
            if files:
                before = np.append(0, up[first[1:] - 1])
                if (files[0], blocks[0]) == own:
                    before[0] -= n
                up = up - np.repeat(before, np.diff(np.append(first, len(up))))
                own, n = (files[-1], blocks[-1]), int(up[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(up)], [*b.schema.names, "upto"])

    fields = "struct<severity:string,file:string,line:int,column:int,message:string>"
    numbered = marked.mapInArrow(counted, f"file string, block long, nth long, at int, text string, head {fields}, upto long")
    totals = numbered.groupBy("file", "block").agg(F.max("upto").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    placed = numbered.join(F.broadcast(starts), ["file", "block"]).withColumn("seq", F.col("upto") + F.col("start")).where("seq > 0")  # a row for each range read
    line = F.when(F.col("head").isNull(), F.struct("block", "nth", "at", strip_ws(F.col("text")).alias("text")))
    whole = placed.groupBy("file", "seq").agg(F.max("head").alias("head"), F.transform(F.array_sort(F.collect_list(line)), lambda x: x["text"]).alias("rest"))
    message = F.when(F.size("rest") > 0, F.concat("head.message", F.lit("\n"), F.array_join("rest", "\n"))).otherwise(F.col("head.message"))
    return whole.select("file", "seq", "head.severity", F.col("head.file").alias("named"), "head.line", "head.column", message.alias("message"))


def public_records(diagnostics: DataFrame) -> DataFrame:
    return diagnostics.drop("file")


def per_exercise(diagnostics: DataFrame, key: str = "ex_id") -> DataFrame:
    """(key, warnings, errors): the diagnostics of each severity in their order."""
    fields = [c for c in ("line", "column", "message", "line_content", "char_at_column") if c in diagnostics.columns]
    of = lambda s: F.transform(F.array_sort(F.collect_list(F.when(F.col("severity") == s, F.struct("seq", *fields)))), lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    return diagnostics.groupBy(key).agg(of("warning").alias("warnings"), of("error").alias("errors"))


def verdicts(exercises: DataFrame, compiled: DataFrame, diagnostics: DataFrame, key: str = "ex_id") -> DataFrame:
    """Adds returncode (-1 if not compiled), warnings, errors, n_warnings, n_errors and is_valid: returncode 0 and no errors."""
    sized = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)).cast("long")
    rows = exercises.join(compiled.select(key, "returncode"), key, "left").join(per_exercise(diagnostics, key), key, "left")
    rows = rows.withColumns({"returncode": F.coalesce("returncode", F.lit(-1)), "n_warnings": sized("warnings"), "n_errors": sized("errors")})
    return rows.withColumn("is_valid", (F.col("returncode") == 0) & (F.col("n_errors") == 0))
