"""Ranked lexical search of all documents for a set of stated queries (items).

Items are taken in blocks of a bounded number of postings. For a block, each document is cut down to the bag of the terms the
block's items have; the bags, as bytes, and the documents' lengths are written once, and all that scoring needs of the corpus
(number of documents, of terms, of documents that hold a term) is counted over that table. A document's score depends on its
bag and on m, a number its length gives. So documents are brought together by a hash of both, compared in full, and each class
of equal ones is scored once; of its members only the first by id can be among an item's best, and their number is bounded
by the result's. A task scores some hundred classes at a time against the block's postings by array operations and keeps each
item's best classes; these meet in a window by item, where members are written out by ascending id.

Scores are whole numbers of 64 bits; a term's weight is the whole part of 1000 ln((2 N + 2) / (2 df + 1)).

Defined results: a null text has no term and is no document of N, nor is a text without terms; an item without terms, or with
none that a document has, has no rows; items that share an id have their rows each; documents that share an id count each;
a null document id (ids are whole numbers) comes last among equal scores; texts of any length are cut between terms at a
million bytes and counted piece by piece; equal scores are ranked by ascending id; empty tables give an empty table; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuskiln.llm.common import materialise, scratch
from corpuskiln.llm.trie import running_sums

#: Postings (an item's distinct terms) of a block of items; a larger item is a block of its own.
POSTINGS = 1 << 19
#: Results of an item.
TOP = 10
#: Weight of the length, in hundredths.
LENGTH_SHARE = 90
#: Bytes of a text that are taken apart at once, and contributions that are added up at once.
PIECE, CONTRIBUTIONS = 1 << 20, 1 << 21


def term_bags(text: bytes) -> Iterator[Counter]:
    """Terms of UTF-8 bytes, only A-Z lowered, counted for each piece of a text."""
    import re

    at, lowered = 0, text if len(text) > PIECE else text.lower()
    while at < len(text):
        gap = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]").search(text, at + PIECE) if len(text) - at > PIECE else None
        end = gap.start() if gap else len(text)
        yield Counter(re.findall(rb"[0-9a-z\x80-\xff]+", lowered if len(text) <= PIECE else text[at:end].lower()))
        at = end


def _binary(column):
    import pyarrow as pa

    return column.cast(pa.binary())


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, terms, block): each item's distinct terms, and the block of at most POSTINGS terms it falls into."""
    import pyarrow as pa

    kind = items.schema[id_col].dataType

    def run(batches):
        for b in batches:
            terms = [sorted(set().union(*term_bags(t or b""))) for t in _binary(b.column(1)).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(terms, pa.list_(pa.binary())), pa.array([0] * b.num_rows, pa.int64()), pa.array([len(t) for t in terms], pa.int64())], ["item_id", "terms", "all", "n"])

    schema = T.StructType([T.StructField("item_id", kind), T.StructField("terms", T.ArrayType(T.BinaryType())), T.StructField("all", T.LongType()), T.StructField("n", T.LongType())])
    found = items.select(id_col, text_col).mapInArrow(run, schema).withColumn("tie", F.xxhash64("terms"))
    placed = running_sums(found.where("n > 0"), "all", ["all", "tie", "item_id"], ["n"])
    return materialise(placed.select("item_id", "terms", F.expr(f"(to_n - 1) DIV {POSTINGS}").alias("block")))


def bags(docs: DataFrame, vocabulary: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, bag): how many terms a document has, and its bag: pairs of a term's place in the vocabulary and its number, as
    32-bit numbers by ascending place."""
    import numpy as np
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(vocabulary)})  # a block's

    def run(batches):
        place = shared.value
        for b in batches:
            sizes, found = [], []
            for text in _binary(b.column(1)).to_pylist():
                n, own = 0, {}
                for counts in term_bags(text or b""):
                    n += counts.total()
                    for t in place.keys() & counts.keys() if len(counts) > len(place) else counts:
                        if (k := place.get(t)) is not None:
                            own[k] = own.get(k, 0) + counts[t]
                sizes.append(n)
                found.append(np.array(sorted(own.items()), "<u4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())], ["id", "n", "bag"])

    return docs.select(id_col, text_col).mapInArrow(run, "id long, n long, bag binary")


def term_documents(found: DataFrame, size: int) -> DataFrame:
    """(term, df): in how many bags each of the vocabulary's terms is."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        own = np.zeros(size, np.int64)
        for b in batches:
            places = np.frombuffer(b"".join(b.column(0).to_pylist()), "<u4")[::2]
            own += np.bincount(places, minlength=size)
        held = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(own[held])], ["term", "df"])

    return found.select("bag").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def bag_classes(found: DataFrame, n_docs: int, n_terms: int, top: int = TOP) -> DataFrame:
    """(bag, m, ids): a row for each class of documents of one bag and m, with its first ids. Documents meet under a hash; what
    makes them equal is that bag and m are."""
    m = F.expr(f"{100 - LENGTH_SHARE} + CAST(n AS DECIMAL(19, 0)) * CAST({LENGTH_SHARE * n_docs} AS DECIMAL(18, 0)) DIV CAST({n_terms} AS DECIMAL(19, 0))")
    rows = found.where("length(bag) > 0").select("id", "bag", m.alias("m")).withColumn("h", F.xxhash64("bag", "m"))
    same = Window.partitionBy("h", "bag", "m")
    first = rows.withColumn("nth", F.row_number().over(same.orderBy(F.col("id").asc_nulls_last()))).where(F.col("nth") <= top)
    listed = first.groupBy("h", "bag", "m").agg(F.array_sort(F.collect_list(F.struct("nth", "id"))).alias("ids"))
    return listed.select("bag", "m", F.transform("ids", lambda x: x["id"]).alias("ids"))


def best_classes(classes: DataFrame, items: list[list[int]], weights, top: int = TOP) -> DataFrame:
    """(item, score, ids): of each task's classes those that may hold one of an item's best documents. items: each item's terms,
    as places; weights: by place."""
    import numpy as np
    import pyarrow as pa

    terms = np.array([t for i in items for t in i], np.int64)
    whose = np.repeat(np.arange(len(items)), [len(i) for i in items])
    order = np.argsort(terms, kind="stable")
    ends = np.cumsum(np.bincount(terms, minlength=len(weights)))
    shared = classes.sparkSession.sparkContext.broadcast((whose[order].astype(np.int32), np.append(0, ends), weights))  # a block's postings

    def run(batches):
        postings, starts, w = shared.value
        n_items = len(items)
        last = np.iinfo(np.int64).max
        best = [np.zeros(0, np.int64) for _ in range(4)]  # item, score, least id, number of the class
        floor = np.ones(n_items, np.int64)
        kept: dict[int, list] = {}
        seen = 0

        def scored(places, counts, m, owner, n):
            """Scores (class, item) of n classes."""
            gain = w[places] * ((10**9 * counts) // (1000 * counts + 8 * m[owner]))
            size = starts[places + 1] - starts[places]
            at = np.repeat(starts[places] - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
            cell = np.repeat(owner * n_items, size) + postings[at]
            gain = np.repeat(gain, size)
            low, high = (np.bincount(cell, x.astype(np.float64), n * n_items).astype(np.int64) for x in (gain & 0xFFFF, gain >> 16))  # exact below 2**53 each
            return ((high << 16) + low).reshape(n, n_items)

        for b in batches:
            raw, ids = b.column(0).to_pylist(), b.column(2).to_pylist()
            m = b.column(1).to_numpy()
            pairs = [np.frombuffer(x, "<u4").reshape(-1, 2).astype(np.int64) for x in raw]
            cost = [int((starts[p[:, 0] + 1] - starts[p[:, 0]]).sum()) + n_items for p in pairs]
            a = 0
            while a < len(pairs):
                z, total = a + 1, cost[a]
                while z < len(pairs) and total + cost[z] <= CONTRIBUTIONS:
                    total += cost[z]
                    z += 1
                flat = np.concatenate(pairs[a:z])
                owner = np.repeat(np.arange(z - a), [len(p) for p in pairs[a:z]])
                scores = scored(flat[:, 0], flat[:, 1], m[a:z], owner, z - a)
                c, i = np.nonzero(scores >= floor)
                if len(c):
                    least = np.array([last if x[0] is None else x[0] for x in ids[a:z]], np.int64)
                    kept.update((seen + k, ids[a + k]) for k in np.unique(c).tolist())
                    best = [np.concatenate(x) for x in zip(best, (i, scores[c, i], least[c], seen + c))]
                    by = np.lexsort((best[2], -best[1], best[0]))
                    best = [x[by] for x in best]
                    first = np.searchsorted(best[0], best[0])
                    keep = np.arange(len(by)) - first < top
                    best = [x[keep] for x in best]
                    tenth = np.flatnonzero(np.arange(len(best[0])) - np.searchsorted(best[0], best[0]) == top - 1)
                    floor[best[0][tenth]] = best[1][tenth]
                    kept = {k: kept[k] for k in np.unique(best[3]).tolist()}
                seen += z - a
                a = z
        for at in range(0, len(best[0]), 10_000):
            part = slice(at, at + 10_000)
            yield pa.RecordBatch.from_arrays([pa.array(best[0][part]), pa.array(best[1][part]), pa.array([kept[k] for k in best[3][part].tolist()], pa.list_(pa.int64()))], ["item", "score", "ids"])

    return classes.select("bag", "m", "ids").mapInArrow(run, "item long, score long, ids array<long>")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Each item's best documents with a score above 0: item id, rank from 1, document id, score."""
    spark = docs.sparkSession
    with scratch(spark):
        return materialise(_search(docs, items, top, id_col, text_col, item_col, item_text_col), outlive=True)


def _search(docs, items, top, id_col, text_col, item_col, item_text_col) -> DataFrame:
    import math

    import numpy as np

    spark = docs.sparkSession
    asked = item_terms(items, item_col, item_text_col)
    names = T.StructType([T.StructField("item", T.LongType()), T.StructField(item_col, items.schema[item_col].dataType)])
    by_score = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    out = spark.createDataFrame([], f"rank int, {id_col} long, score long").select(F.lit(None).cast(names[1].dataType).alias(item_col), "rank", id_col, "score")
    n_docs = n_terms = None
    for block in range((asked.agg(F.max("block")).first()[0] or 0) + 1):
        rows = asked.where(F.col("block") == block).select("item_id", "terms").collect()  # at most POSTINGS terms, or one item
        vocabulary = sorted({t for r in rows for t in map(bytes, r["terms"])})
        found = materialise(bags(docs, vocabulary, id_col, text_col))
        if n_docs is None:
            n_docs, n_terms = found.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not rows or not n_docs:
            continue
        df = {r["term"]: r["df"] for r in term_documents(found, len(vocabulary)).collect()}  # a number a term of the block
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(k, 0) + 1))) for k in range(len(vocabulary))], np.int64)
        place = {t: k for k, t in enumerate(vocabulary)}
        best = best_classes(bag_classes(found, n_docs, n_terms, top), [[place[bytes(t)] for t in r["terms"]] for r in rows], weights, top)
        ranked = best.select("item", "score", F.explode("ids").alias("doc")).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)
        ids = spark.createDataFrame([(k, r["item_id"]) for k, r in enumerate(rows)], names)
        out = out.unionByName(materialise(ranked.join(ids, "item").select(item_col, "rank", F.col("doc").alias(id_col), "score")))
    return out


def op13_ranked_search(spark, sf_dir: str) -> DataFrame:
    return ranked_search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
OP13_SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS.format("text")} AS ts FROM documents WHERE text IS NOT NULL),
held AS (SELECT doc_id, len(ts) AS n, ts FROM d WHERE len(ts) > 0),
size AS (SELECT count(*) AS nn, sum(n)::BIGINT AS l FROM held),
tf AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, n, unnest(ts) AS t FROM held) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, size GROUP BY t, nn),
asked AS (SELECT item_id, unnest(list_distinct({_TERMS.format("text")})) AS t FROM benchmark),
s AS (SELECT item_id, doc_id, sum(w.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // l))))::BIGINT AS score FROM asked JOIN tf USING (t) JOIN w USING (t), size GROUP BY 1, 2)
SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM s WHERE score > 0) WHERE rank <= 10
"""
