"""Line dedup within a bound of edits, by joining deletion neighbourhoods.

Lines are compared in lower case with white space collapsed. Two lines are within ``edits`` of each other exactly if there
is a text v, both lines with some characters deleted, such that substitutions are characters deleted from both at the same
place of v, and all others were inserted or deleted: with m matched places, and x and y characters deleted from the one and
the other without a match, m + x + y is at most ``edits``. So each line sends out all its variants of up to that many
deletions, hashed to 128 bits with each choice of matched places. Of two lines under one key, what each has unmatched
decides: the earliest line within the bound is a minimum over the key's lines, and no pairs are formed. What a key says is
verified by an edit distance between the texts before it counts.

So that not every line sends out its neighbourhood, filters that lose nothing go before. Cut into one more part than there
may be edits, the shorter of two lines has a part that the longer has as well, at a place that follows from the number of
edits on both sides; lines that share no such part with any other are left out, and a bit set of bounded size tells which
texts to fetch for that. For one edit, of the rest two lines agree outside one of sixteen segments, and lines that agree
with none so are left out as well.

A line is dropped if it occurred before, or if any line within the bound occurred before, kept or not; before means in a
document of a lesser id, or earlier in the same. That holds for lines of any length.

The number of variants grows with the line's length to the power of ``edits``; with two, a line of 100 characters has
20,000 keys, so a bound of two is for short lines or small tables.

Defined results: a null text is one empty line; blank lines are never dropped; ids may be of any type that has an order,
rows of a null id come after all others and, of equal ones, the first stays (see ``common.ranked_rows``); where ids are
whole numbers, rows that share one count as one document, and a line that first occurs in it stays in each of its rows; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations, islice

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.llm.common import SALT_MASK, bit_filter, materialise, may_hold, ranked_rows, salt_of, scratch, unmask

EDITS = 1
#: Variants that a task makes at once, about.
PART = 1 << 16
_B1, _B2 = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1


def normal(line: str) -> str:
    return " ".join(line.lower().split())


def digests(line: str) -> tuple[int, int]:
    import xxhash

    d = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass"))
    return (d >> 64) - (1 << 63), (d & ((1 << 64) - 1)) - (1 << 63)


def _key(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def part_keys(line: str, edits: int = EDITS) -> list[int]:
    """Keys of which two lines within the bound share one: parts of the shorter, at the places the longer may have them.

    If a part before which at most ``part`` edits stand is whole, its shift lies within that many places, and within the
    edits left after it of the difference in length."""
    out = {}
    for least in range(max(1, len(line) - edits), len(line) + 1):  # the shorter line's length
        more = len(line) - least
        for part in range(edits + 1):
            a, b = part * least // (edits + 1), (part + 1) * least // (edits + 1)
            for shift in range(max(-part, more - edits + part, -a), min(part, more + edits - part) + 1):
                out[_key(f"{least}:{part}:{line[a + shift : b + shift]}")] = None
    return list(out)


SEGMENTS = 16


def segment_keys(line: str) -> list[int]:
    """Keys of which two lines within one edit share one: all but a segment, for the shorter line's length."""
    out = []
    for least in (len(line), len(line) - 1):
        for s in range(SEGMENTS):
            head, tail = s * least // SEGMENTS, least - (s + 1) * least // SEGMENTS
            out.append(_key(f"{s}:{least}:{line[:head]}\n{line[len(line) - tail :]}"))
    return out


def _prefix_sums(line: str):
    import numpy as np

    from corpuskiln.llm.words import mixed

    c = mixed(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1))
    out = []
    with np.errstate(over="ignore"):
        for base in (_B1, _B2):
            up = np.full(len(c) + 1, base, np.uint64)
            up[0] = 1
            up = np.multiply.accumulate(up)
            out.append(np.append(np.uint64(0), np.cumsum(c * up[:-1])))
    return out


def own_digest(line: str) -> tuple[int, int]:
    """What variants are under that equal the line itself."""
    v1, v2, _, _ = next(neighbourhood(line, 0))
    return int(v1[0]), int(v2[0])


def _deleted(n: int, gone: int):
    """All choices of that many places of n, as rows of arrays of at most PART columns."""
    import numpy as np

    if gone < 2:
        every = np.arange(n)[None] if gone else np.zeros((0, 1), np.int64)
        yield from (every[:, at : at + PART] for at in range(0, every.shape[1], PART))
        return
    ways = combinations(range(n), gone)
    while some := list(islice(ways, PART)):
        yield np.array(some, np.int64).T


def _variants(sums: list, n: int, at) -> tuple:
    """(v1, v2, unmatched, matched) of a text of n characters without those at each column's places, under each choice of
    which of them are matched."""
    import numpy as np

    from corpuskiln.llm.words import mixed

    gone, found = len(at), ([], [], [], [])
    places = (at - np.arange(gone)[:, None]).astype(np.uint64)  # in the variant
    with np.errstate(over="ignore"):
        hashes = []
        for k, base in enumerate((_B1, _B2)):
            inverse, h, scale, before = np.uint64(pow(base, -1, 1 << 64)), np.zeros(at.shape[1], np.uint64), np.uint64(1), np.zeros(at.shape[1], np.int64)
            for p in [*at, np.full(at.shape[1], n)]:
                h = h + (sums[k][p] - sums[k][before]) * scale
                before, scale = p + 1, scale * inverse
            hashes.append(mixed(mixed(h) + np.uint64(n - gone) + np.uint64(k)))
        for matched in range(gone + 1):
            for chosen in combinations(range(gone), matched):
                for k in (0, 1):
                    h = hashes[k]
                    for c in chosen:
                        h = mixed(h * np.uint64(3) + places[c] + np.uint64(1))
                    found[k].append(h.view(np.int64))
                found[2].append(np.full(at.shape[1], gone - matched, np.int32))
                found[3].append(np.full(at.shape[1], matched, np.int32))
    return tuple(map(np.concatenate, found))


def neighbourhood(line: str, edits: int = EDITS):
    """Parts (v1, v2, unmatched, matched) of all variants with each choice of matched places; v1 and v2 are signed 64-bit
    numbers. A part has the variants of at most PART choices of places."""
    sums = _prefix_sums(line)
    for gone in range(min(edits, len(line)) + 1):
        for at in _deleted(len(line), gone):
            yield _variants(sums, len(line), at)


def line_table(ranked: DataFrame, edits: int) -> DataFrame:
    """ranked (rank, text): a row for each line that isn't blank: h1, h2, rank, nth, again (it was there before in this
    document) and keys, its part keys, null where it is there again."""
    import pyarrow as pa

    names = ["h1", "h2", "rank", "nth", "again", "keys"]
    kinds = (*[pa.int64()] * 4, pa.bool_(), pa.list_(pa.int64()))

    def run(batches):
        for b in batches:
            rows = []
            for rank, text in zip(b.column(0).to_pylist(), b.column(1)):
                seen = set()
                for nth, raw in enumerate(text.as_py().split("\n")):
                    if line := normal(raw):
                        again = line in seen
                        seen.add(line)
                        rows.append((*digests(line), rank, nth, again, None if again else part_keys(line, edits)))
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return ranked.select("rank", "text").mapInArrow(run, "h1 long, h2 long, rank long, nth long, again boolean, keys array<long>")


def _shared_keys(keyed: DataFrame) -> DataFrame:
    """keyed (key, h1, h2): the keys that two different lines have, with the salts of their rows."""
    salted = keyed.withColumn("salt", salt_of(F.col("h2")))
    return salted.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high"), F.expr(SALT_MASK).alias("salts")).where("low < high").select("key", "salts")


def _with_shared(keyed: DataFrame, shared: DataFrame) -> DataFrame:
    """The h1, h2 of keyed rows whose key is shared."""
    return keyed.withColumn("salt", salt_of(F.col("h2"))).join(unmask(shared), ["key", "salt"]).select("h1", "h2").distinct()


def candidate_lines(ranked: DataFrame, table: DataFrame, edits: int) -> DataFrame:
    """h1, h2, line, rank, nth of the lines that the filters leave, each at its first place. The table's keys say which they
    are; only then are their texts fetched."""
    import pyarrow as pa
    import pyarrow.compute as pc

    own = table.where("keys IS NOT NULL")
    shared = materialise(_shared_keys(own.select(F.explode("keys").alias("key"), "h1", "h2")))
    context = ranked.sparkSession.sparkContext
    bits = context.broadcast(bit_filter(shared, "key", shared.count()))  # of bounded size

    def likely(batches):
        for b in batches:
            keys = b.column(2).flatten()
            held = pa.array(may_hold(bits.value, keys.to_numpy()))
            of = pc.list_parent_indices(b.column(2)).filter(held)
            yield pa.RecordBatch.from_arrays([keys.filter(held), b.column(0).take(of), b.column(1).take(of)], ["key", "h1", "h2"])

    keyed = own.select("h1", "h2", "keys").mapInArrow(likely, "key long, h1 long, h2 long")
    chosen = materialise(_with_shared(keyed, shared))
    wanted = context.broadcast(bit_filter(chosen, "h1", chosen.count()))  # of bounded size

    def fetch(batches):
        """Of a batch's lines that may be chosen each one once, with its earliest place there."""
        import numpy as np

        for b in batches:
            lines, places, said = [], [], []
            for rank, text in zip(b.column(0).to_pylist(), b.column(1)):
                for nth, raw in enumerate(text.as_py().split("\n")):
                    if line := normal(raw):
                        lines.append(line)
                        places.append((rank, nth))
                        said.append(digests(line))
            h = np.array(said, np.int64).reshape(-1, 2)
            least: dict = {}
            for k in np.flatnonzero(may_hold(wanted.value, h[:, 0])).tolist():
                if said[k] not in least or places[k] < places[least[said[k]]]:
                    least[said[k]] = k
            at = list(least.values())
            columns = (h[at, 0], h[at, 1], [lines[k] for k in at], [places[k][0] for k in at], [places[k][1] for k in at])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], ["h1", "h2", "line", "rank", "nth"])

    # a hot line is one row of each batch, and one of each task after the partial minimum
    fetched = ranked.select("rank", "text").mapInArrow(fetch, "h1 long, h2 long, line string, rank long, nth long")
    first = fetched.groupBy("h1", "h2").agg(F.min(F.struct("rank", "nth")).alias("at"), F.first("line").alias("line"))
    lines = materialise(first.join(chosen, ["h1", "h2"], "left_semi").select("h1", "h2", "line", "at.rank", "at.nth"))
    if edits != 1:
        return lines

    def segments(batches):
        for b in batches:
            keys = [segment_keys(line) for line in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.list_(pa.int64()))], ["h1", "h2", "keys"])

    keyed = lines.select("h1", "h2", "line").mapInArrow(segments, "h1 long, h2 long, keys array<long>").select(F.explode("keys").alias("key"), "h1", "h2")
    return materialise(lines.join(_with_shared(keyed, _shared_keys(keyed)), ["h1", "h2"], "left_semi"))


def near_losers(ranked: DataFrame, table: DataFrame, edits: int = EDITS) -> DataFrame:
    """h1, h2 of the lines of which a line within the bound occurred before."""
    with scratch(ranked.sparkSession):
        return _near_losers(ranked, table, edits)


def _near_losers(ranked: DataFrame, table: DataFrame, edits: int) -> DataFrame:
    import pyarrow as pa

    lines = candidate_lines(ranked, table, edits)

    def own(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([own_digest(line)[0] for line in b.column(0).to_pylist()], pa.int64())], ["v1"])

    bits = ranked.sparkSession.sparkContext.broadcast(bit_filter(lines.select("line").mapInArrow(own, "v1 long"), "v1", lines.count()))  # of bounded size

    def send(batches):
        import numpy as np

        def parts(b):
            """Lists of (row, part), together of at most about PART variants."""
            waiting, n = [], 0
            for k, line in enumerate(b.column(2)):
                for part in neighbourhood(line.as_py(), edits):
                    waiting.append((k, part))
                    n += len(part[0])
                    if n >= PART:
                        yield waiting
                        waiting, n = [], 0
            if waiting:
                yield waiting

        for b in batches:
            for made in parts(b):
                v1, v2, unmatched, matched = (np.concatenate([x[k] for _, x in made]) for k in range(4))
                of = np.repeat([k for k, _ in made], [len(x[0]) for _, x in made])
                # all edits used up by deletions: only a line itself can be under the same key
                good = (unmatched < edits) | (matched > 0) | may_hold(bits.value, v1)
                of = pa.array(of[good])
                yield pa.RecordBatch.from_arrays([pa.array(v1[good]), pa.array(v2[good]), pa.array(unmatched[good]), pa.array(edits - matched[good]), *[b.column(k).take(of) for k in (0, 1, 3, 4)]], ["v1", "v2", "unmatched", "budget", "h1", "h2", "rank", "nth"])

    sent = lines.select("h1", "h2", "line", "rank", "nth").mapInArrow(send, "v1 long, v2 long, unmatched int, budget int, h1 long, h2 long, rank long, nth long")
    me, key = F.struct("rank", "nth", "h1", "h2"), Window.partitionBy("v1", "v2")  # different lines under a key: at most what the alphabet gives
    least = {u: F.min(F.when(F.col("unmatched") == u, me)).over(key) for u in range(edits + 1)}
    earliest = F.least(*[F.when(F.col("unmatched") + u <= F.col("budget"), c) for u, c in least.items()], F.lit(None).cast("struct<rank:bigint,nth:bigint,h1:bigint,h2:bigint>"))
    met = sent.withColumns({"me": me, "first": earliest}).where("first < me").select("h1", "h2", "rank", "nth", "first").distinct()

    text_of = lambda side: lines.select(F.col("h1").alias(f"{side}1"), F.col("h2").alias(f"{side}2"), F.col("line").alias(f"{side}_line"))
    named = met.select(F.col("h1").alias("m1"), F.col("h2").alias("m2"), F.col("first.h1").alias("f1"), F.col("first.h2").alias("f2"))
    with_texts = named.join(text_of("m"), ["m1", "m2"]).join(text_of("f"), ["f1", "f2"])
    return materialise(with_texts.where(F.levenshtein("m_line", "f_line", edits) >= 0).select(F.col("m1").alias("h1"), F.col("m2").alias("h2")).distinct(), outlive=True)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS) -> DataFrame:
    """One row per document: id, n_lines, n_dropped, n_near (how many of them only nearly), dropped (numbers of the lines, from 0)."""
    ranked = ranked_rows(docs, id_col, text_col)
    table = materialise(line_table(ranked, edits))
    near = near_losers(ranked, table, edits).select("h1", "h2", F.lit(True).alias("near"))
    every = table.where("NOT again").select("h1", "h2", "rank", "nth", salt_of(F.col("rank")).alias("salt"))
    lines = every.groupBy("h1", "h2").agg(F.min("rank").alias("first"), F.max("rank").alias("last"), F.expr(SALT_MASK).alias("salts"))
    known = lines.join(near, ["h1", "h2"], "left").where("first < last OR near").select("h1", "h2", "first", "salts", F.coalesce("near", F.lit(False)).alias("near"))
    late = every.join(unmask(known), ["h1", "h2", "salt"]).where("near OR first < rank").select("rank", "nth", (F.col("near") & (F.col("first") == F.col("rank"))).alias("near"))
    lost = late.unionByName(table.where("again").select("rank", "nth", F.lit(False).alias("near")))
    by_doc = lost.groupBy("rank", "nth").agg(F.bool_or("near").alias("near")).groupBy("rank").agg(F.sort_array(F.collect_list("nth")).alias("dropped"), F.count_if("near").alias("near"))
    sizes = ranked.select("id", "rank", F.size(F.split("text", "\n", -1)).alias("n_lines"))
    return sizes.join(by_doc, "rank", "left").select(
        F.col("id").alias(id_col), "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).alias("n_dropped"),
        F.coalesce("near", F.lit(0)).cast("long").alias("n_near"), F.coalesce("dropped", F.array().cast("array<long>")).alias("dropped"),
    )


def drop_lines(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the dropped lines taken out of their texts. Ids must be unique; rows of a null id, or of one without a
    decision, keep theirs."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("key"))
    joined = packed.join(decisions.select(F.col(id_col).alias("key"), F.col("dropped").alias("lost")), "key", "left")
    lines = F.transform(F.split(F.col("row")[text_col], "\n", -1), lambda x, k: F.struct(x.alias("line"), k.cast("long").alias("nth")))
    kept = F.filter(lines, lambda x: ~F.coalesce(F.array_contains("lost", x["nth"]), F.lit(False)))
    text = F.array_join(F.transform(kept, lambda x: x["line"]), "\n")
    return joined.select(*[(text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    return line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
