"""Similarity join of documents by the Jaccard index of their word shingles, with Bayesian candidate pruning.

1. Each text becomes the set of its five-word shingles and a signature of 128 MinHash values. Equal sets are one node
   from here on, a number, however many rows have them.
2. Nodes that agree in a band of four values are candidates: at the threshold a pair is missed in all 32 bands with a
   probability below 1e-7. A band's bucket is dealt to blocks; every two blocks of a bucket meet in a task of bounded
   size. There all pairs that meet in no earlier band compare their values sixteen at a time, and a pair is dropped as
   soon as the posterior probability of reaching the threshold is below ``tolerance``. The task gives a spanning forest
   of the pairs that are left, never the pairs.
3. The forests' connected components bound where links can be. Within each, blocks of nodes meet with their sets: pairs
   go through the same pruning, and those left are verified exactly. A task gives each node's number of links and again
   a spanning forest, whose components are the classes.

So no stage has a row per pair, no task more than two blocks, and copies are never expanded. What is compared, and how often
a set is sent, does grow with the size of a component: one of g different sets is sent g / BLOCK times.

A word is as in ``words``: lower-case runs of ASCII letters, digits, underscores and all characters beyond ASCII. A text
of fewer words has one shingle of them all; a text without words has one shingle, itself.

Defined results: a null text is empty, and so is one without words: they are equal to each other and to no other; shingles are
those of whole texts, of any length; a pair exactly at the threshold is linked; rows that share an id are rows of their own; a null id is counted but can't name
a class unless all of its rows are null; an empty table gives an empty table; other columns are ignored by
``similar_groups`` and handed through by ``drop_near_copies``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import SALT_MASK, connected, materialise, one_row_per_key, salt_of, scratch, spread_join, unmask

SHINGLE = 5
THRESHOLD = 0.8
HASHES, ROWS = 128, 4
BANDS = HASHES // ROWS
STEP = 16
TOLERANCE = 1e-7
#: Nodes of a block; a task has two.
BLOCK = 256
#: Bytes of shingles that a block has at most, about: two of them are in memory at once.
BLOCK_BYTES = 48 << 20


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """After each STEP values: the fewest equal ones with P(similarity >= threshold | matches) >= tolerance, prior uniform."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        # posterior Beta(m + 1, n - m + 1); its upper tail is a binomial sum
        tail = lambda m: sum(math.comb(n + 1, i) * threshold**i * (1 - threshold) ** (n + 1 - i) for i in range(m + 1))  # noqa: E731,B023
        out.append(next(m for m in range(n + 1) if tail(m) >= tolerance))
    return out


def shingle_set(text: str):
    """Sorted distinct 64-bit hashes."""
    import numpy as np

    from corpuskiln.llm.words import shingle_hashes, words_of

    h = shingle_hashes(words_of(text)[0], SHINGLE)
    if not len(h):
        import xxhash

        h = np.array([xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))], np.uint64)
    return np.unique(h)


def _family():
    import numpy as np

    rng = np.random.default_rng(20240229)
    return rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles, family):
    """HASHES values of 16 bits."""
    import numpy as np

    least = None
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 512):
            x = shingles[at : at + 512, None] * family[None, :]
            part = ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)).min(axis=0)
            least = part if least is None else np.minimum(least, part)
        return ((least * np.uint64(0x94D049BB133111EB)) >> np.uint64(48)).astype(np.uint16)


def _identity(shingles) -> bytes:
    import hashlib

    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, node (128 bits of the shingle set), n (its shingles), sig."""
    import pyarrow as pa

    def run(batches):
        family = _family()
        for b in batches:
            nodes, sizes, sigs = [], [], []
            for text in b.column(1):
                s = shingle_set(text.as_py() or "")
                nodes.append(_identity(s))
                sizes.append(len(s))
                sigs.append(signature(s, family).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int32()), pa.array(sigs, pa.binary())], ["id", "node", "n", "sig"])

    return docs.select(id_col, text_col).mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, node binary, n int, sig binary")


def with_node(docs: DataFrame, text_col: str) -> DataFrame:
    """docs as row, and node."""
    import pyarrow as pa

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("__text"))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_identity(shingle_set(t.as_py() or "")) for t in b.column(1)], pa.binary())], ["row", "node"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, node binary")


class Forest:
    """Union-find over 0..n-1, the least of each tree on top."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        a, b = sorted((self.root(x), self.root(y)))
        self.up[b] = a

    def edges(self) -> list[tuple[int, int]]:
        """From each tree's top to its others: where groups are dealt to many tasks, most of these agree."""
        return [(self.root(x), x) for x in range(len(self.up)) if self.root(x) != x]


def pairs_of(starts, sizes):
    """All index pairs within each of several small groups of neighbouring rows."""
    import numpy as np

    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in np.unique(sizes[sizes > 1]).tolist():
        x, y = np.triu_indices(n, 1)
        at = starts[sizes == n]
        a.append((at[:, None] + x).ravel())
        b.append((at[:, None] + y).ravel())
    return np.concatenate(a), np.concatenate(b)


def crossing(start: int, size: int, i, j, mine):
    """Index pairs of one large group: within its block, or between its two."""
    import numpy as np

    if i[start] == j[start]:
        x, y = np.triu_indices(size, 1)
        return x + start, y + start
    rows = np.arange(start, start + size)
    left, right = rows[mine[rows] == i[start]], rows[mine[rows] == j[start]]
    return np.repeat(left, len(right)), np.tile(right, len(left))


def surviving_pairs(sigs, a, b, least: list[int], band=None):
    """Those of the index pairs a, b whose signatures pass the pruning; with band, a number for each row, only pairs that
    meet in no earlier band."""
    import numpy as np

    if band is not None and len(a):
        bands = np.ascontiguousarray(sigs).view(np.uint64)
        fresh = (bands[a] == bands[b]).argmax(axis=1) == band[a]
        a, b = a[fresh], b[fresh]
    equal = np.zeros(len(a), np.int32)
    for k, need in enumerate(least):
        if not len(a):
            break
        at = slice(k * STEP, (k + 1) * STEP)
        equal += (sigs[a, at] == sigs[b, at]).sum(axis=1, dtype=np.int32)
        good = equal >= need
        a, b, equal = a[good], b[good], equal[good]
    return a, b


def _blocks(members: DataFrame, keys: list[str], carry: list[str], wide: str) -> DataFrame:
    """Deals each group's rows to blocks of about BLOCK, and fewer where those have over about BLOCK_BYTES in the column wide;
    each row goes to every pair of blocks that has its own.

    Adds i <= j, the pair, and mine, the row's block. A group of g rows makes g * g / BLOCK of them, spread evenly."""
    salted = members.withColumn("salt", salt_of(F.col("node")))
    sizes = salted.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"), F.sum(F.octet_length(wide)).alias("bytes"), F.expr(SALT_MASK).alias("salts")).where("size > 1")
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("bytes") / BLOCK_BYTES)).cast("int")
    dealt = salted.join(unmask(sizes), [*keys, "salt"]).withColumn("blocks", blocks)
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return paired.select(*keys, *carry, "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))


def candidate_edges(nodes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """a, b: a spanning forest of the pairs that some band brings together and pruning leaves."""
    import pyarrow as pa

    least = least_matches(threshold, tolerance)
    bands = nodes.select("node", "sig", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.substring("sig", k * (2 * ROWS) + 1, F.lit(2 * ROWS)))).alias("band", "value"))
    narrow = bands.select("node", "band", "value").withColumn("salt", salt_of(F.col("node")))
    shared = narrow.groupBy("band", "value").agg(F.count(F.lit(1)).alias("size"), F.expr(SALT_MASK).alias("salts")).where("size > 1")
    keyed = unmask(shared.select("band", "value", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"), "salts"))
    met = narrow.join(keyed, ["band", "value", "salt"]).select("node", "band", "value", "blocks")
    # whose bands met; each gets its signature once, then goes where it is needed
    met = met.groupBy("node").agg(F.collect_list(F.struct("band", "value", "blocks")).alias("met")).join(nodes.select("node", "sig"), "node")
    met = met.select("node", "sig", F.explode("met").alias("m")).select("node", "sig", "m.*").withColumn("mine", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int"))
    paired = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = paired.select("band", "value", "node", "sig", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))

    keys = ["band", "value", "i", "j"]

    def meet(batches):
        """Sorted rows: a call per bucket would cost more than most buckets' work, so all whole buckets of a batch are one step."""
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            starts = bucket_starts(table)
            rest = table.slice(starts[-1])
            if starts[-1]:
                yield from joined(table.slice(0, starts[-1]), starts[:-1])
        if rest is not None and rest.num_rows:
            yield from joined(rest, bucket_starts(rest))

    def bucket_starts(table):
        import numpy as np

        table = table.combine_chunks()
        value = np.frombuffer(b"".join(table["value"].to_pylist()), np.uint64)
        change = np.zeros(len(value), bool)
        change[:1] = True
        for x in (table["band"].to_numpy(), value, table["i"].to_numpy(), table["j"].to_numpy()):
            change[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(change)

    def joined(table, starts):
        import numpy as np

        names = table["node"].to_pylist()
        sigs = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint16).reshape(len(names), HASHES)
        band, i, j, mine = (table[c].to_numpy() for c in ("band", "i", "j", "mine"))
        sizes = np.diff(np.append(starts, len(names)))
        small = sizes <= 32
        forest = Forest(len(names))
        a, b = pairs_of(starts[small], sizes[small])
        own = (i[a] == j[a]) | (mine[a] != mine[b])
        for x, y in [(a[own], b[own]), *(crossing(k, n, i, j, mine) for k, n in zip(starts[~small].tolist(), sizes[~small].tolist()))]:
            for at in range(0, len(x), 1 << 16):
                p, q = surviving_pairs(sigs, x[at : at + (1 << 16)], y[at : at + (1 << 16)], least, band)
                for u, v in zip(p.tolist(), q.tolist()):
                    forest.join(u, v)
        edges = forest.edges()
        yield pa.RecordBatch.from_arrays([pa.array([names[p] for p, _ in edges], pa.int64()), pa.array([names[q] for _, q in edges], pa.int64())], ["a", "b"])

    return paired.repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(meet, "a long, b long")


def verified_links(sets: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """sets (root, node, weight, sig, shingles): node, links and doc_links (summands of both), a and b (edges of a forest)."""
    import pyarrow as pa

    least = least_matches(threshold, tolerance)
    paired = _blocks(sets, ["root"], ["node", "weight", "sig", "shingles"], "shingles")

    def meet(table: pa.Table) -> pa.Table:
        import numpy as np

        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        table = table.sort_by("node")
        names, weight = table["node"].to_pylist(), table["weight"].to_numpy()
        sigs = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint16).reshape(len(names), HASHES)
        sets_ = [np.frombuffer(s.as_buffer(), np.uint64) for s in table["shingles"].combine_chunks()]
        mine = table["mine"].to_numpy()
        a, b = crossing(0, len(names), np.full(1, i), np.full(1, j), mine)
        a, b = surviving_pairs(sigs, a, b, least)
        links, docs, forest = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64), Forest(len(names))
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        for at in np.split(np.arange(len(a)), np.flatnonzero(np.diff(a)) + 1) if len(a) else []:
            p, partners = int(a[at[0]]), b[at]
            own = sets_[p]
            size = np.array([len(sets_[q]) for q in partners])
            near = (np.minimum(size, len(own)) >= threshold * np.maximum(size, len(own)) - 1e-9)
            partners, size = partners[near], size[near]
            if not len(partners):
                continue
            others = np.concatenate([sets_[q] for q in partners])
            found = own[np.minimum(np.searchsorted(own, others), len(own) - 1)] == others
            common = np.add.reduceat(found.astype(np.int64), np.cumsum(size) - size)
            # Jaccard >= threshold in whole numbers of thousandths, so that a tie is a link
            linked = common * 1000 >= round(threshold * 1000) * (size + len(own) - common)
            q = partners[linked]
            links[p] += len(q)
            links[q] += 1
            docs[p] += weight[q].sum()
            docs[q] += weight[p]
            for k in q.tolist():
                forest.join(p, k)
        used = np.flatnonzero(links)
        rows = [(names[k], int(links[k]), int(docs[k]), None, None) for k in used.tolist()] + [(None, 0, 0, names[p], names[q]) for p, q in forest.edges()]
        kinds = [pa.int64()] * 5
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["node", "links", "doc_links", "a", "b"])

    return paired.groupBy("root", "i", "j").applyInArrow(meet, "node long, links long, doc_links long, a long, b long")


def numbered_nodes(rows: DataFrame) -> DataFrame:
    """rows is a sketch: node (from here on a number, given once), key (its 128 bits), weight, least_id, sig, salts of its rows."""
    salted = rows.withColumn("salt", salt_of(F.col("id")))
    nodes = salted.groupBy(F.col("node").alias("key")).agg(F.count(F.lit(1)).alias("weight"), F.min("id").alias("least_id"), F.any_value("sig").alias("sig"), F.expr(SALT_MASK).alias("salts"))
    return materialise(nodes.withColumn("node", F.monotonically_increasing_id()))


def linked_nodes(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """nodes are those of docs' sketch. node, root (of its class), links, doc_links, for nodes with links."""
    with scratch(docs.sparkSession):
        return _linked_nodes(docs, nodes, id_col, text_col, threshold, tolerance)


def _linked_nodes(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, threshold: float, tolerance: float) -> DataFrame:
    import pyarrow as pa

    roots = connected(candidate_edges(nodes, threshold, tolerance))

    def sets(batches):
        for b in batches:
            keys, shingles = [], []
            for text in b.column(0):
                s = shingle_set(text.as_py() or "")
                keys.append(_identity(s))
                shingles.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(shingles, pa.binary())], ["key", "shingles"])

    # one text of each node that needs its set: the row of its least id (rows of null ids: any)
    wanted = materialise(roots.join(nodes.drop("salts"), "node"))
    ids = wanted.where("least_id IS NOT NULL").select(F.col("least_id").alias("id")).distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # one plan at every size: a broadcast that a small input gets would not carry over
    chosen = texts.join(ids.hint("merge"), "id", "left_semi").unionByName(texts.where("id IS NULL"))
    found = chosen.select("text").mapInArrow(sets, "key binary, shingles binary").dropDuplicates(["key"])
    checked = materialise(verified_links(wanted.join(found, "key"), threshold, tolerance))
    counts = checked.where("node IS NOT NULL").groupBy("node").agg(F.sum("links").alias("links"), F.sum("doc_links").alias("doc_links"))
    classes = connected(checked.where("a IS NOT NULL").select("a", "b"))
    return materialise(counts.join(classes, "node"), outlive=True)


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: id, class_id (the least id of its class), class_size, n_links (other documents at or above the
    threshold), n_text_links (other shingle sets at or above it)."""
    rows = materialise(sketch(docs, id_col, text_col))
    nodes = numbered_nodes(rows)
    linked = linked_nodes(docs, nodes, id_col, text_col, threshold, tolerance)
    nodes = materialise(nodes.drop("sig").join(linked, "node", "left").withColumn("root", F.coalesce("root", "node")))
    classes = nodes.groupBy("root").agg(F.min("least_id").alias("class_id"), F.sum("weight").alias("class_size"))
    facts = spread_join(nodes, classes, "root", F.col("node")).select(F.col("key").alias("node"), "class_id", "class_size", (F.coalesce("doc_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("links", F.lit(0)).alias("n_text_links"), "salts")
    return spread_join(rows.select("id", "node"), facts, "node", F.col("id")).select(F.col("id").alias(id_col), "class_id", "class_size", "n_links", "n_text_links")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One document of each class, that of the least id (nulls last), with the columns docs came with."""
    with scratch(docs.sparkSession):
        nodes = numbered_nodes(sketch(docs, id_col, text_col))
        linked = linked_nodes(docs, nodes, id_col, text_col, threshold, tolerance)
        inner = materialise(nodes.select("node", "key", "least_id").join(linked.select("node", "root"), "node"))
        heads = inner.groupBy("root").agg(F.min(F.struct(F.col("least_id").isNull(), "least_id", "node"))["node"].alias("head"))
        lost = materialise(spread_join(inner, heads, "root", F.col("node")).where("node != head").select(F.col("key").alias("node")), outlive=True)
    staying = with_node(docs, text_col).join(lost, "node", "left_anti")
    order = [F.col("row")[id_col].asc_nulls_last(), F.xxhash64(F.col("row")[text_col])]
    return one_row_per_key(staying, ["node"], order, F.col("row")[id_col]).select("row.*")


def op2_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return similar_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
