"""One JSON document larger than a task: read in byte ranges, its exercises parsed in many tasks.

A structural index takes the place of a parser that runs from the first byte. Ranges are read as pieces that end at a closing
brace, a byte that is part of no other character. For each range, whatever came before it, three things say what it does to
the state of a scan: whether it has an odd number of quotes, by how much it changes the depth, and how low it goes, the last
two for both cases, that it begins inside a text or not. Running totals over the ranges, a row each, then give every range
the state it begins in.

The values to parse alone are those that open at a depth that every range comes down to somewhere, so none reaches over more
than two ranges: for a list of any length, wherever it stands in the document, its items. Those that lie in one range are
parsed there; the two parts of one that doesn't meet in a group-by. What lies around them, the skeleton, is a row a range, runs
of values in it being one sign, and is parsed for each file, so that a document is only good if all of it is.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuskiln.functions import jsonx
from corpuskiln.sources.exercises import rows_in
from corpuskiln.sources.shared import materialise, read_in_ranges, scratch

#: Bytes of a range, and those that are looked at together.
RANGE, CHUNK = 64 << 20, 4 << 20
#: What stands for a value in a skeleton.
HOLE = b"\0"
_RUN = re.compile(rb"\0(?:[ \t\r\n]*,[ \t\r\n]*\0)+")
TOO_LARGE = "an exercise reaches over more than two ranges of the file"


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, size, piece): the files' bytes in ranges, each cut behind its closing braces, which are left off."""
    rows = spark.read.option("lineSep", "}").text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("piece"))


def _chunks(batches):
    """((file, block, size), pieces) of some neighbouring rows of one range, in order, of about CHUNK bytes."""
    own, waiting, n = None, [], 0
    for b in batches:
        for file, block, size, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
            piece = piece.as_py()
            if waiting and ((file, block, size) != own or n > CHUNK):
                yield own, waiting
                waiting, n = [], 0
            own = (file, block, size)
            waiting.append(piece)
            n += len(piece) + 1
    if waiting:
        yield own, waiting


def structure(data: bytes):
    """(places of brackets, +1 or -1 for each, quotes up to each, quotes in all) of bytes that begin behind no backslash."""
    import numpy as np

    raw = np.frombuffer(data, np.uint8)
    wanted = np.zeros(256, bool)
    wanted[list(b'"[]{}')] = True
    at = np.flatnonzero(wanted[raw])
    kind = raw[at]
    quote = kind == 34
    doubtful = np.flatnonzero(quote & (at > 0))
    doubtful = doubtful[raw[at[doubtful] - 1] == 92]
    for k in doubtful.tolist():  # escaped behind an odd number of backslashes
        end = at[k]
        start = end - 1
        while start >= 0 and raw[start] == 92:
            start -= 1
        quote[k] = (end - 1 - start) % 2 == 0
    quotes = np.cumsum(quote)
    bracket = kind != 34
    step = np.where((kind == 91) | (kind == 123), 1, -1)[bracket]
    return at[bracket], step, quotes[bracket], int(quotes[-1]) if len(quotes) else 0


def _summaries(batches):
    """A row a range: file, block, size, its pieces and bytes, whether it has an odd number of quotes, and change and least of
    the depth if it begins outside a text (0) and inside one (1)."""
    import numpy as np
    import pyarrow as pa

    found: dict = {}
    for own, parts in _chunks(batches):
        data = b"}".join(parts) + b"}"
        _, step, quotes, n = structure(data)
        now = []
        for inside in (0, 1):
            depth = np.cumsum(step[(quotes + inside) % 2 == 0])
            now.append((int(depth[-1]), min(0, int(depth.min()))) if len(depth) else (0, 0))
        count, size, odd, change, least = found.get(own, (0, 0, 0, (0, 0), (0, 0)))
        nexts = [now[inside ^ odd] for inside in (0, 1)]
        found[own] = (
            count + len(parts), size + len(data) - len(parts), odd ^ (n & 1),
            tuple(change[i] + nexts[i][0] for i in (0, 1)), tuple(min(least[i], change[i] + nexts[i][1]) for i in (0, 1)),
        )
    rows = [(*own, count, size, odd, *change, *least) for own, (count, size, odd, change, least) in found.items()]
    kinds = [pa.string(), *[pa.int64()] * 9]
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["file", "block", "size", "n", "bytes", "odd", "change0", "change1", "least0", "least1"])


def ranges(found: DataFrame) -> DataFrame:
    """(file, block, inside, depth, level, last, n): the state each range begins in, and the level at which values are parsed
    alone; last if the file's last brace isn't followed by a piece of its own, so that its last piece ends in none."""
    rows = found.mapInArrow(_summaries, "file string, block long, size long, n long, bytes long, odd long, change0 long, change1 long, least0 long, least1 long")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    zero = lambda c: F.coalesce(c, F.lit(0))
    rows = rows.withColumn("inside", zero(F.sum("odd").over(before)) % 2)
    own = lambda name: F.when(F.col("inside") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    rows = rows.withColumn("change", own("change")).withColumn("depth", zero(F.sum("change").over(before)))
    level = F.greatest(F.lit(0), F.max(F.col("depth") + own("least")).over(whole))
    cut = (F.sum("bytes").over(whole) + F.sum("n").over(whole) > F.col("size")) & (F.col("block") == F.max("block").over(whole))
    return rows.select("file", "block", "inside", "depth", level.alias("level"), cut.alias("last"), "n")


def _reader(states: dict, what: str):
    """Rows of ranges: 'exercise' rows (nth in its range, raw_json or error), 'tail' and 'head' (bytes of a value that reaches
    into the next range, or comes from the one before) and 'skeleton'."""
    import pyarrow as pa

    names = ["file", "block", "kind", "nth", "raw_json", "error", "content"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def run(batches):
        import numpy as np

        own, state = None, None

        def ended():
            """The rows that a range ends with."""
            file, block, _ = own
            rows = [(file, block, "skeleton", 0, None, None, _RUN.sub(HOLE, bytes(state["around"])))]
            if state["open"]:
                rows.append((file, block, "tail" if state["began"] else "head", 0, None, None, bytes(state["value"])))
            return rows

        for key, parts in _chunks(batches):
            rows: list[tuple] = []
            if key != own:
                if own:
                    rows += ended()
                own = key
                inside, depth, level, last, n = states[key[:2]]
                state = {"inside": inside, "depth": depth, "open": depth > level, "began": False, "value": bytearray(), "around": bytearray(), "nth": 0, "left": n, "level": level, "last": last}
            file, block, _ = key
            state["left"] -= len(parts)
            data = b"}".join(parts) + (b"" if state["last"] and not state["left"] else b"}")
            at, step, quotes, n_quotes = structure(data)
            outside = (quotes + state["inside"]) % 2 == 0
            at, step = at[outside], step[outside]
            depth = state["depth"] + np.cumsum(step)
            turns = np.flatnonzero(((step > 0) & (depth == state["level"] + 1)) | ((step < 0) & (depth == state["level"])))
            done = 0
            for k in turns.tolist():
                if step[k] > 0:
                    state["around"] += data[done : at[k]].replace(HOLE, b"\1") + HOLE
                    done, state["open"], state["began"] = int(at[k]), True, True
                else:
                    state["value"] += data[done : at[k] + 1]
                    done = int(at[k]) + 1
                    if state["began"]:
                        found, error = rows_in(bytes(state["value"]), what)
                        for x in found:
                            rows.append((file, block, "exercise", state["nth"], x, None, None))
                            state["nth"] += 1
                        if error:
                            rows.append((file, block, "exercise", state["nth"], None, error, None))
                    else:
                        rows.append((file, block, "head", 0, None, None, bytes(state["value"])))
                    state["open"], state["began"] = False, False
                    state["value"].clear()
            if state["open"]:
                state["value"] += data[done:]
            else:
                state["around"] += data[done:].replace(HOLE, b"\1")
            if len(state["around"]) > CHUNK:
                state["around"] = bytearray(_RUN.sub(HOLE, bytes(state["around"])))
            state["depth"] = int(depth[-1]) if len(depth) else state["depth"]
            state["inside"] = (state["inside"] + n_quotes) % 2
            for a in range(0, len(rows), 1000):
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[a : a + 1000]], t) for k, t in enumerate(kinds)], names)
        if own:
            rows = ended()
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    return run


def _checked(what: str):
    """The skeletons of files to (file, error), for those that aren't good."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            out = []
            for file, parts in zip(b.column(0).to_pylist(), b.column(1)):
                said = _RUN.sub(HOLE, b"".join(parts.as_py()))
                value, error = jsonx.loads_bytes(said.replace(HOLE, b" 0 "))
                if not error and next(jsonx.exercises_in(value, what == "exercises"), None) is not None:
                    error = TOO_LARGE
                out.append((file, error))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.string()) for k in (0, 1)], ["file", "error"])

    return run


def _parsed(what: str):
    """Values whose two parts have met: (file, block, nth, raw_json, error)."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            rows = []
            for file, block, parts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                found, error = rows_in(b"".join(parts.as_py()), what)
                rows += [(file, block, nth, x, None) for nth, x in enumerate(found)] + ([(file, block, 0, None, error)] if error else [])
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["file", "block", "nth", "raw_json", "error"])

    return run


def parse_huge_documents(spark: SparkSession, path: str, what: str = "exercises", range_bytes: int = RANGE) -> DataFrame:
    """(file, ordinal, raw_json, error) of JSON files of any size, as ``parse_documents`` gives of (file, content), for the kinds
    'exercises' and 'strict'. A file that isn't good gives one row with an error. Ranges are parsed once, into the shared folder.
    An exercise may be as long as a range; a file with one that reaches over more than two isn't good."""
    if what not in ("exercises", "strict"):
        raise ValueError(f"no such kind: {what}")
    with scratch(spark):
        return _parse(spark, pieces(read_in_ranges(spark, range_bytes), path), what)


def _parse(spark: SparkSession, read: DataFrame, what: str) -> DataFrame:
    states = {(r["file"], r["block"]): (r["inside"], r["depth"], r["level"], r["last"], r["n"]) for r in ranges(read).collect()}  # a row a range
    schema = "file string, block long, kind string, nth long, raw_json string, error string, content binary"
    rows = materialise(read.mapInArrow(_reader(states, what), schema), session=spark)
    order = F.struct("block", F.when(F.col("kind") == "tail", 1).otherwise(0).alias("at"))
    # a tail and the head of the next range that has one are one value
    ends = rows.where("kind IN ('tail', 'head')")
    group = F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0)).over(Window.partitionBy("file").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    named = ends.select("file", "block", "kind", group.alias("value"))  # two narrow rows a range
    met = ends.join(named, ["file", "block", "kind"]).groupBy("file", "value").agg(F.min("block").alias("block"), F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), "content"))), lambda x: x["content"]).alias("parts"))
    crossing = met.select("file", "block", "parts").mapInArrow(_parsed(what), "file string, block long, nth long, raw_json string, error string")
    own = rows.where("kind = 'exercise'").select("file", "block", "nth", "raw_json", "error")
    # the value that reaches out of a range is its last
    sizes = own.groupBy("file", "block").agg(F.count(F.lit(1)).alias("own"))
    crossing = materialise(crossing.join(sizes, ["file", "block"], "left").withColumn("nth", F.col("nth") + F.coalesce("own", F.lit(0))).drop("own"))
    every = own.unionByName(crossing)
    skeletons = rows.where("kind = 'skeleton'").groupBy("file").agg(F.transform(F.array_sort(F.collect_list(F.struct("block", "content"))), lambda x: x["content"]).alias("parts"))
    faults = skeletons.mapInArrow(_checked(what), "file string, error string").unionByName(every.select("file", "error")).where("error IS NOT NULL")
    faults = materialise(faults.groupBy("file").agg(F.min("error").alias("error")))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = every.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n")).select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    good = every.join(faults.select("file"), "file", "left_anti").join(counts, ["file", "block"])
    bad = faults.select("file", F.lit(1).cast("long").alias("ordinal"), F.lit(None).cast("string").alias("raw_json"), "error")
    return materialise(good.select("file", (F.col("nth") + F.col("start") + 1).alias("ordinal"), "raw_json", F.lit(None).cast("string").alias("error")).unionByName(bad), outlive=True)
