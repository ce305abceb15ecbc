"""Substring dedup by hashing lines, and passages inside them.

Every line that isn't blank is a unit, whatever its length. Its digest is that of its words in lower case (words as in
``words``; A-Z and the capitals of Latin-1 are lowered), so punctuation and spacing don't count; a line without words is
taken as it stands, without the white space around it.

Repeated text also stands in the middle of longer lines, so passages are units as well. A passage begins at a cut: at the
first word, at a word before which a line feed, full stop, exclamation or question mark stands, and at anchors: of any
``window`` words in a row, the one whose hash of itself and the next word is least. It is the words from there to the next
cut at least ``min_words`` further. A cut depends on nothing but the words around it, so a passage is found wherever in a
line it was put; of its outer words those before its first and after its last cut stay. ``min_words`` says what a passage
is and nothing about lines: a shorter line is removed as a line. Without it (None) only lines are units.

Of equal units the earliest stays: that of the least id, in it the first. What any of the others covers is removed, with
the line feed after a line and the white space after a passage; within a document a unit counts as repeated only after the
first one's end. Removed spans are merged where they meet; their offsets are those of characters in the original text.

Units, as 96 bits of a digest of their normalised bytes, are written to the shared folder once. Each digest's first document comes from a group-by
with partial sums; documents then learn of their own repeats by a join on (first 64 bits, salt), so a unit that a third of
all documents share is dealt to many tasks; a bit set of bounded size keeps most unshared units out of that join.

Defined results: a null or empty text has no units and an empty clean text; blank lines are no units; ids may be of any
type that has an order, rows of a null id come after all others and, of equal ones, the first stays (see
``common.ranked_rows``); where ids are whole numbers, rows that share one count as one document and lose what earlier
documents have; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import SALT_MASK, bit_filter, materialise, may_hold, ranked_rows, salt_of, scratch, unmask

#: The least words of a passage inside a line.
MIN_WORDS = 8
#: So narrow that a whole passage lies inside any 50 words.
WINDOW = 13
#: Words of a removed span that counts in n_removed, of which whole lines and what edges cost leave fewer.
SPAN_WORDS = 25


def anchors(words, window: int):
    """Which words are anchors: the least hash, of a word and the next, in some full window. Equal ones all are."""
    import numpy as np

    from corpuskiln.llm.words import mixed

    def sliding(of, x):
        size = 1
        while size < window:
            by = min(size, window - size)
            x, size = of(x[:-by], x[by:]), size + by
        return x

    out = np.zeros(len(words), bool)
    if len(words) > window:
        with np.errstate(over="ignore"):
            h = mixed(words[:-1] + words[1:] * np.uint64(0xD6E8FEB86659FD93))
        least = np.zeros(len(h) + window - 1, np.uint64)
        least[window - 1 : len(h)] = sliding(np.minimum, h)
        out[:-1] = sliding(np.maximum, least) == h
    return out


def units_of(text: str, min_words: int | None = MIN_WORDS, window: int = WINDOW):
    """Arrays (first byte, byte after, h1, h2, is a line) of a text's units: first its lines, then its passages, each in order."""
    import numpy as np
    import xxhash

    from corpuskiln.llm.words import END, joined_words, latin_lower, words_of

    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    lowered = latin_lower(raw)
    words, starts, ends = words_of(lowered, False)
    n = len(words)
    feeds = np.flatnonzero(raw == 10)
    line_at, line_end = np.append(0, feeds + 1), np.append(feeds + 1, len(raw))
    p = np.searchsorted(starts, line_at)
    q = np.append(p[1:], n)
    worded = q > p
    bare = []  # lines without words
    for k in np.flatnonzero(~worded & (line_end - line_at > 1)).tolist():
        if body := raw[line_at[k] : line_end[k]].tobytes().strip():
            bare.append((k, xxhash.xxh3_128_digest(body, 2)))
    cut = np.zeros(n, bool)
    if min_words and n >= min_words:
        marks = np.append(0, np.cumsum(END[raw]))
        cut[1:] = marks[starts[1:]] > marks[ends[:-1]]
        cut |= anchors(words, window)
        cut[0] = True
    piece = np.append(np.flatnonzero(cut), n)
    stop = np.searchsorted(piece, piece[:-1] + (min_words or 1))
    good = stop < len(piece)
    at = np.append(starts, len(raw))
    at[:1] = 0
    first, after = np.concatenate([p[worded], piece[:-1][good]]), np.concatenate([q[worded], piece[stop[good]]])
    lines = int(worded.sum())
    body, places = joined_words(lowered, starts, ends)
    digest, body = xxhash.xxh3_128_digest, memoryview(body)
    own = [digest(body[a:b], k < lines) for k, (a, b) in enumerate(zip(places[first].tolist(), (places[after] - 1).tolist()))]
    own[lines:lines] = [d for _, d in bare]
    said = np.frombuffer(b"".join(own), "<u4").reshape(-1, 4)
    begin = np.concatenate([line_at[worded], [line_at[k] for k, _ in bare], at[first[lines:]]]).astype(np.int64)
    end = np.concatenate([line_end[worded], [line_end[k] for k, _ in bare], at[after[lines:]]]).astype(np.int64)
    h1, h2 = np.ascontiguousarray(said[:, :2]).view(np.int64).ravel(), np.ascontiguousarray(said[:, 2]).view(np.int32)
    return begin, end, h1, h2, np.arange(len(h1)) < lines + len(bare)


def distinct_units(ranked: DataFrame, min_words: int | None, window: int) -> DataFrame:
    """ranked (rank, text): (h1, h2, rank), each of a document's digests once a row."""
    import pyarrow as pa

    def run(batches):
        import numpy as np

        for b in batches:
            ranks, one, two = [], [], []
            for rank, text in zip(b.column(0).to_pylist(), b.column(1)):
                _, _, h1, h2, _ = units_of(text.as_py(), min_words, window)
                if len(h1):
                    _, at = np.unique(h1, return_index=True)
                    ranks.append(np.full(len(at), rank))
                    one.append(h1[at])
                    two.append(h2[at])
            if ranks:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(one)), pa.array(np.concatenate(two)), pa.array(np.concatenate(ranks), pa.int64())], ["h1", "h2", "rank"])

    return ranked.select("rank", "text").mapInArrow(run, "h1 long, h2 int, rank long")


def repeats(ranked: DataFrame, min_words: int | None = MIN_WORDS, window: int = WINDOW) -> DataFrame:
    """rank and seen: the digests of its units that an earlier document has, with that document's rank."""
    import pyarrow as pa

    spark = ranked.sparkSession
    with scratch(spark):
        units = materialise(distinct_units(ranked, min_words, window))
        salted = units.withColumn("salt", salt_of(F.col("rank")))
        groups = salted.groupBy("h1", "h2").agg(F.min("rank").alias("first"), F.max("rank").alias("last"), F.expr(SALT_MASK).alias("salts"))
        shared = materialise(groups.where("first < last").select("h1", "h2", "first", "salts"))
        bits = spark.sparkContext.broadcast(bit_filter(shared, "h1", shared.count()))  # of bounded size

        def likely(batches):
            for b in batches:
                yield b.filter(pa.array(may_hold(bits.value, b.column(0).to_numpy())))

        mine = units.select("h1", "rank").mapInArrow(likely, "h1 long, rank long")
        # the wide side travels without h2; the document compares its own
        key = unmask(shared).withColumnRenamed("h1", "key")
        late = mine.join(key, (F.col("h1") == F.col("key")) & (salt_of(F.col("rank")) == F.col("salt"))).where("first < rank")
        return materialise(late.groupBy("rank").agg(F.collect_list(F.struct("h1", "h2", "first")).alias("seen")), outlive=True)  # a document's own units


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int | None = MIN_WORDS, window: int = WINDOW) -> DataFrame:
    """One row per document: id, n_lines and n_passages (its units), n_lines_removed and n_passages_removed (those of them
    that are repeats), n_removed (removed spans of at least SPAN_WORDS words), longest_removed (words of the longest),
    chars_removed (by all spans, of any length), clean_text, removed (start, stop and the first document's rank)."""
    import pyarrow as pa

    ranked = ranked_rows(docs, id_col, text_col)
    joined = ranked.join(repeats(ranked, min_words, window), "rank", "left").select("id", "text", "rank", "seen")
    span = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("first_doc", pa.int64())])
    kind = docs.schema[id_col].dataType.simpleString()
    counts = ["n_lines", "n_passages", "n_lines_removed", "n_passages_removed", "n_removed", "longest_removed", "chars_removed"]

    def run(batches):
        import numpy as np

        from corpuskiln.llm.words import words_of

        for b in batches:
            numbers, clean, spans = [], [], []
            for text, rank, seen in zip(b.column(1), b.column(2).to_pylist(), b.column(3)):
                text = text.as_py()
                start, stop, h1, h2, is_line = units_of(text, min_words, window)
                gone, first = np.zeros(len(h1), bool), np.full(len(h1), rank)
                if seen.is_valid:
                    known = [seen.values.field(k).to_numpy() for k in range(3)]
                    order = np.argsort(known[0])
                    place = np.searchsorted(known[0], h1, sorter=order)
                    for k in (0, 1):  # two digests may share h1
                        at = order[np.minimum(place + k, len(order) - 1)]
                        same = (known[0][at] == h1) & (known[1][at] == h2)
                        first[same] = known[2][at][same]
                        gone |= same
                mine = {}
                _, group, count = np.unique(h1, return_inverse=True, return_counts=True)
                for k in np.flatnonzero(~gone & (count[group] > 1)).tolist():
                    if mine.setdefault(int(group[k]), stop[k]) <= start[k]:
                        gone[k] = True
                out = []
                lost = np.flatnonzero(gone)
                for k in lost[np.argsort(start[lost], kind="stable")].tolist():
                    if out and start[k] <= out[-1][1]:
                        out[-1][1] = max(out[-1][1], int(stop[k]))
                    else:
                        out.append([int(start[k]), int(stop[k]), int(first[k])])
                chars, sizes = 0, [0]
                if out:
                    raw = text.encode("utf-8", "surrogatepass")
                    edges = [0, *[x for s in out for x in s[:2]], len(raw)]
                    parts = [raw[x:y].decode("utf-8", "surrogatepass") for x, y in zip(edges, edges[1:])]
                    places = np.append(0, np.cumsum([len(x) for x in parts])).tolist()
                    clean.append("".join(parts[0::2]))
                    spans.append([{"start": places[2 * k + 1], "stop": places[2 * k + 2], "first_doc": s[2]} for k, s in enumerate(out)])
                    chars, sizes = sum(map(len, parts[1::2])), [len(words_of(x, False)[0]) for x in parts[1::2]]
                else:
                    clean.append(text)
                    spans.append([])
                numbers.append((is_line.sum(), (~is_line).sum(), (gone & is_line).sum(), (gone & ~is_line).sum(), sum(x >= SPAN_WORDS for x in sizes), max(sizes), chars))
            table = np.array(numbers, np.int32).reshape(-1, len(counts)).T
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, table), pa.array(clean, pa.string()), pa.array(spans, pa.list_(span))], [id_col, *counts, "clean_text", "removed"])

    return joined.mapInArrow(run, f"{id_col} {kind}, {', '.join(f'{c} int' for c in counts)}, clean_text string, removed array<struct<start:int,stop:int,first_doc:long>>")


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def repeated_lines(spark, sf_dir: str) -> DataFrame:
    """The operator on lines alone, which SQL can express."""
    found = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), min_words=None)
    return found.select("doc_id", "n_lines", "n_lines_removed", F.md5("clean_text").alias("clean_md5"))


#: The capitals of ASCII and Latin-1.
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
LINES_SQL = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nth, len(string_split(coalesce(text, ''), chr(10))) AS n FROM documents),
w AS (SELECT *, array_to_string(regexp_extract_all(translate(line, '{CAPITALS}', '{CAPITALS.lower()}'), '[0-9a-z_\x{{80}}-\x{{10FFFF}}]+'), ' ') AS words, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS bare FROM l),
u AS (SELECT *, CASE WHEN words <> '' THEN 'w' || words WHEN bare <> '' THEN 'b' || bare END AS unit FROM w),
r AS (SELECT *, unit IS NOT NULL AND row_number() OVER (PARTITION BY unit ORDER BY doc_id, nth) > 1 AS gone FROM u)
SELECT doc_id, count(unit)::INT AS n_lines, count(*) FILTER (gone)::INT AS n_lines_removed,
  md5(coalesce(string_agg(line || CASE WHEN nth < n THEN chr(10) ELSE '' END, '' ORDER BY nth) FILTER (NOT gone), '')) AS clean_md5
FROM r GROUP BY doc_id
"""
