"""The trie of conversations that begin alike, rolled up by centroid decomposition.

A node is a sequence of first turns. Its key is 128 bits: the sum over its turns of a hash of each turn's place and SHA-256, so
keys of all prefixes are running sums, made over range-partitioned rows whatever share of them one conversation has.
Counting rows by key gives each node's members, and its weight: the turns, with repeats, of its members from it on.

Subtree totals take no pass for each level. The forest of parent edges (the root aside) falls into components, each with one
top; at first these are the subtrees of first turns. Nodes with over half of their component's weight lie on one path from its
top; the lowest of them is the centroid, and every part that is left without it has at most half the weight. Each round finds
the centroids of all components above LOCAL turns, gives the total of what hangs from a centroid to all nodes on its path to
the top, and parts the component: what hangs below falls to the centroid's children, the rest keeps its top, its path's
weights lessened. So rounds grow with the logarithm of the largest component, not with the depth, and no task gets a component
above LOCAL turns; the smaller ones are summed up from below where their rows lie together.

Defined results: turns are in the order of their number, nulls first, equal ones by the SHA-256 of role and text; a null role
or text counts as empty; repeated rows are turns of their own; rows of a null conversation are left out; texts of any length
are hashed where they are and never shuffled; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuskiln.llm.common import materialise, scratch, spread_join

#: Turns of a component, with repeats, up to which one task sums it up.
LOCAL = 4096


def running_sums(rows: DataFrame, key: str, order: list[str], values: list[str]) -> DataFrame:
    """rows with to_<value> for each of the values (longs): their sum, modulo 2**64, over the key's rows up to this one.

    order begins with the key; rows equal in it come in any order. Rows are dealt to ranges and summed up there; a key whose
    rows lie in several ranges has its sums of the ranges before added. What the driver gets of that is a row or two for each
    range."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    names = rows.columns
    schema = T.StructType([*rows.schema.fields, *[T.StructField(f"to_{v}", T.LongType()) for v in values], T.StructField("__range", T.IntegerType()), T.StructField("__nth", T.LongType())])

    def summed(batches):
        at, last, carry, nth = TaskContext.get().partitionId(), None, np.zeros(len(values), np.uint64), 0
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(names.index(key)).to_numpy()
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            sums = []
            for k, v in enumerate(values):
                with np.errstate(over="ignore"):
                    up = np.cumsum(b.column(names.index(v)).to_numpy().view(np.uint64), dtype=np.uint64)
                    before = np.append(np.uint64(0), up[first[1:] - 1])
                    if keys[0] == last:
                        before[0] -= carry[k]
                    up = up - np.repeat(before, np.diff(np.append(first, len(keys))))
                sums.append(up)
            last, carry = keys[-1], np.array([s[-1] for s in sums], np.uint64)
            nths = np.arange(nth, nth + b.num_rows)
            nth += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(s.view(np.int64)) for s in sums], pa.array(np.full(b.num_rows, at, np.int32)), pa.array(nths)], schema.fieldNames())

    placed = materialise(dealt.mapInArrow(summed, schema))
    ends = sorted(tuple(r) for r in placed.groupBy("__range").agg(F.min(key), F.max(key)).collect())  # a row a range
    cut = sorted({a[2] for a, b in zip(ends, ends[1:]) if a[2] == b[1]})
    plain = placed.drop("__range", "__nth")
    outs = plain.columns
    if not cut:
        return plain
    whose = F.broadcast(placed.sparkSession.createDataFrame([(k,) for k in cut], T.StructType([T.StructField(key, T.LongType())])))  # fewer than ranges
    parts = placed.join(whose, key).groupBy("__range", key).agg(F.max_by(F.struct(*[f"to_{v}" for v in values]), "__nth").alias("sums"))
    offsets: dict[int, dict] = {}
    so_far: dict = {}
    for r in sorted(parts.collect(), key=lambda r: r["__range"]):
        before = so_far.get(r[key], np.zeros(len(values), np.uint64))
        offsets.setdefault(r["__range"], {})[r[key]] = before
        with np.errstate(over="ignore"):
            so_far[r[key]] = before + np.array(tuple(r["sums"]), np.int64).view(np.uint64)

    def moved(batches):
        for b in batches:
            keys, ranges = b.column(names.index(key)).to_numpy(), b.column(b.num_columns - 2).to_numpy()
            sums = [b.column(len(names) + k).to_numpy().view(np.uint64).copy() for k in range(len(values))]
            for at in np.unique(ranges):
                for own, before in offsets.get(int(at), {}).items():
                    here = (ranges == at) & (keys == own)
                    for k, s in enumerate(sums):
                        with np.errstate(over="ignore"):
                            s[here] += before[k]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], *[pa.array(s.view(np.int64)) for s in sums]], outs)

    return materialise(placed.mapInArrow(moved, plain.schema))


def numbered_turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(c, pos, digest, n_bytes): turns numbered from 1 in each conversation's order."""
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    known = rows.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("c"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"), F.lit(1).cast("long").alias("one"))
    return running_sums(known, "c", ["c", "turn", "digest"], ["one"]).select("c", F.col("to_one").alias("pos"), "digest", "n_bytes")


def trie(turns: DataFrame, lengths: DataFrame, local: int = LOCAL) -> DataFrame:
    """turns (c, pos from 1, digest, n_bytes) and lengths (c, len), a row for each conversation, those without turns too, to a
    row a node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    with scratch(turns.sparkSession):
        return materialise(_trie(turns, lengths, local), outlive=True)


def _trie(turns: DataFrame, lengths: DataFrame, local: int) -> DataFrame:
    import pyarrow as pa

    place = lambda seed: F.xxhash64(F.lit(seed), F.col("digest"), F.col("pos"))
    hashed = spread_join(turns, lengths.select("c", "len"), "c", F.col("pos")).select("c", F.col("pos").alias("d"), "n_bytes", (F.col("len") - F.col("pos") + 1).alias("left"), place(1).alias("v1"), place(2).alias("v2"))
    paths = _with_parents(running_sums(hashed, "c", ["c", "d"], ["v1", "v2"]))
    summary = [F.min("c").alias("m"), F.max("d").alias("depth"), F.count(F.lit(1)).alias("n"), F.sum("left").alias("w"), F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("n_bytes").alias("n_bytes")]
    tops = paths.where("d = 1").select(F.col("c").alias("m"), F.col("k1").alias("t1"), F.col("k2").alias("t2"))
    counted = spread_join(paths.groupBy("k1", "k2").agg(*summary), tops, "m", F.col("depth"))
    nodes = materialise(counted.select("*", (F.col("w") == F.col("n")).cast("long").alias("leaf"), ((F.col("n") - 1) * F.col("n_bytes")).alias("saved")))

    sums = [F.sum("leaves").alias("n_leaves"), F.sum("saves").alias("saved_tokens"), F.sum("children").alias("n_children")]
    children = nodes.groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("children")).select("k1", "k2", F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saves"), "children")
    parts = _rolled_up(nodes, paths, local).withColumn("children", F.lit(0).cast("long")).unionByName(children)
    totals = parts.groupBy("k1", "k2").agg(*sums)
    ends = _ends(paths.where("left = 1").select("k1", "k2", "c").unionByName(lengths.where("len = 0").select(F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), "c")))

    every = lengths.agg(F.min("c"), F.count(F.lit(1))).first()
    least, n_all = every
    up = nodes.where("depth > 1").select("k1", "k2", "p1", "p2")
    parents = spread_join(up, nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("m").alias("parent")), ["p1", "p2"], F.col("k1")).select("k1", "k2", "parent")
    first = F.lit(least).cast("long")
    inner = nodes.select("k1", "k2", "m", "depth", "n").join(totals, ["k1", "k2"]).join(parents, ["k1", "k2"], "left").withColumn("parent", F.when(F.col("depth") == 1, first).otherwise(F.col("parent")))
    inner = materialise(inner)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    root = inner.where("depth = 1").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.count(F.lit(1)).alias("n_children")).select(
        F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), first.alias("m"), F.lit(0).cast("long").alias("depth"), F.lit(n_all).cast("long").alias("n"),
        F.greatest(zero("n_leaves"), F.lit(1)).cast("long").alias("n_leaves"), zero("saved_tokens").alias("saved_tokens"), "n_children", F.lit(None).cast("long").alias("parent"),
    ).where(F.lit(n_all > 0))
    done = inner.unionByName(root).join(ends, ["k1", "k2"], "left")
    return done.select(
        F.col("m").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def _with_parents(paths: DataFrame) -> DataFrame:
    """(c, d, n_bytes, left, k1, k2, p1, p2): the keys of the prefix that ends here, and of the one before."""
    import numpy as np
    import pyarrow as pa

    names = paths.columns

    def run(batches):
        for b in batches:
            col = lambda n: b.column(names.index(n)).to_numpy().view(np.uint64)
            with np.errstate(over="ignore"):
                before = [pa.array((col(f"to_{v}") - col(v)).view(np.int64)) for v in ("v1", "v2")]
            yield pa.RecordBatch.from_arrays([*[b.column(names.index(n)) for n in ("c", "d", "n_bytes", "left", "to_v1", "to_v2")], *before], ["c", "d", "n_bytes", "left", "k1", "k2", "p1", "p2"])

    return materialise(paths.mapInArrow(run, "c long, d long, n_bytes long, left long, k1 long, k2 long, p1 long, p2 long"))


_NODE = ["k1", "k2", "p1", "p2", "m", "depth", "w", "leaf", "saved", "t1", "t2"]


def _rolled_up(nodes: DataFrame, paths: DataFrame, local: int) -> DataFrame:
    """Parts (k1, k2, leaves, saves) whose sums by key are the totals over each node's subtree."""
    large = nodes.where((F.col("depth") == 1) & (F.col("w") > local)).select("t1", "t2", F.col("w").alias("total"))
    if large.isEmpty():
        return _from_below(nodes)
    parts = []
    small = nodes.select(*_NODE).join(large.hint("merge"), ["t1", "t2"], "left_anti")
    state = materialise(spread_join(nodes.select(*_NODE), large, ["t1", "t2"], F.col("k1")))
    # the paths of the members that stand for a node of a large component
    asked = state.select(F.col("m").alias("c")).distinct()
    known = materialise(spread_join(paths.select("c", "d", "k1", "k2", "p1", "p2"), asked, "c", F.col("d")))
    x = F.struct("k1", "k2", "m", "depth", "w")
    while True:
        small = small.unionByName(state.where(F.col("total") <= local).select(*_NODE))
        left = state.where(F.col("total") > local)
        if left.isEmpty():
            break
        heavy = 2 * F.col("w") > F.col("total")
        centroids = left.where(heavy).groupBy("t1", "t2").agg(F.min_by(x, "w").alias("x"))
        met = materialise(spread_join(left, centroids, ["t1", "t2"], F.col("k1")).withColumn("on_path", heavy))
        # below the centroid lies what has it on its path: the prefix one turn longer than the centroid says so, and by which child
        deeper = met.where("depth > x.depth").select("k1", "k2", F.col("m").alias("c"), (F.col("x.depth") + 1).alias("d"), F.col("x.k1").alias("x1"), F.col("x.k2").alias("x2"))
        child = known.select("c", "d", F.col("k1").alias("b1"), F.col("k2").alias("b2"), "p1", "p2")
        below = spread_join(deeper, child, ["c", "d"], F.col("k1")).where("p1 = x1 AND p2 = x2").select("k1", "k2", "b1", "b2")
        sorted_out = materialise(met.join(below, ["k1", "k2"], "left"))
        itself = (F.col("k1") == F.col("x.k1")) & (F.col("k2") == F.col("x.k2"))
        hanging = sorted_out.where(F.col("b1").isNotNull() | itself).groupBy("t1", "t2").agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saves"))
        given = spread_join(sorted_out.where("on_path").select("k1", "k2", "t1", "t2"), hanging, ["t1", "t2"], F.col("k1"))
        parts.append(materialise(given.select("k1", "k2", "leaves", "saves")))
        rest = sorted_out.where(~itself)
        above = rest.where("b1 IS NULL").withColumns({"w": F.when(F.col("on_path"), F.col("w") - F.col("x.w")).otherwise(F.col("w")), "total": F.col("total") - F.col("x.w")})
        fallen = rest.where("b1 IS NOT NULL").withColumns({"t1": F.col("b1"), "t2": F.col("b2")}).select(*_NODE)
        new = fallen.where("k1 = t1 AND k2 = t2").select("t1", "t2", F.col("w").alias("total"))
        state = materialise(above.select(*_NODE, "total").unionByName(spread_join(fallen, new, ["t1", "t2"], F.col("k1")).select(*_NODE, "total")))
    out = _from_below(small)
    for p in parts:
        out = out.unionByName(p)
    return out


def _from_below(nodes: DataFrame) -> DataFrame:
    """Subtree totals of components that are small: each lies in one task, its deepest nodes first, and sums go up its edges."""
    import pyarrow as pa

    columns = ["k1", "k2", "p1", "p2", "t1", "t2", "leaf", "saved"]

    def run(batches):
        top, waiting = None, {}
        for b in batches:
            leaves, saves = [], []
            for k1, k2, p1, p2, t1, t2, leaf, saved in zip(*[c.to_pylist() for c in b.columns[: len(columns)]]):
                if (t1, t2) != top:
                    top, waiting = (t1, t2), {}
                below = waiting.pop((k1, k2), (0, 0))
                leaf, saved = leaf + below[0], saved + below[1]
                up = waiting.get((p1, p2), (0, 0))
                waiting[p1, p2] = up[0] + leaf, up[1] + saved
                leaves.append(leaf)
                saves.append(saved)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(leaves, pa.int64()), pa.array(saves, pa.int64())], ["k1", "k2", "leaves", "saves"])

    dealt = nodes.select(*columns, "depth").repartition("t1", "t2").sortWithinPartitions("t1", "t2", F.col("depth").desc())
    return dealt.mapInArrow(run, "k1 long, k2 long, leaves long, saves long")


def _ends(members: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of members (k1, k2, c): the digest of each key's ids, ascending.

    Ids are written out and joined where ranges of them lie; the one task that a key's digest needs gets a few long texts."""
    import pyarrow as pa

    def joined(batches):
        for b in batches:
            rows: list[tuple] = []
            for k1, k2, c in zip(*[c.to_pylist() for c in b.columns]):
                if rows and rows[-1][0] == k1 and rows[-1][1] == k2:
                    rows[-1][3].append(str(c))
                else:
                    rows.append((k1, k2, c, [str(c)]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)] + [pa.array([",".join(r[3]) for r in rows], pa.string())], ["k1", "k2", "first", "ids"])

    def digested(batches):
        from hashlib import sha256

        key, digest = None, None
        for b in batches:
            out = []
            for k1, k2, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()):
                if (k1, k2) == key:
                    digest.update(b"," + ids.encode())
                else:
                    if key:
                        out.append((*key, digest.hexdigest()))
                    key, digest = (k1, k2), sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))], ["k1", "k2", "ends_sha256"])
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, digest.hexdigest())], ["k1", "k2", "ends_sha256"])

    texts = members.repartitionByRange("k1", "k2", "c").sortWithinPartitions("k1", "k2", "c").mapInArrow(joined, "k1 long, k2 long, first long, ids string")
    return texts.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInArrow(digested, "k1 long, k2 long, ends_sha256 string")


#: The conversations that begin with turns of one are this many ids apart at most, and take up to so many turns of it.
SHARED, MOST_SHARED = 5, 8


def _shared(c: Column) -> Column:
    """How many turns a conversation takes over."""
    return (F.crc32(c.cast("string")) % (MOST_SHARED + 1)).cast("long")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths) of the conversations that begin with turns of another: c takes the first h of c - c % 5 and goes on with
    its own behind its first h, where h is a checksum of c."""
    own = numbered_turns(conversations)
    sizes = materialise(own.groupBy("c").agg(F.max("pos").alias("n")))
    base = F.col("c") - F.col("c") % SHARED
    info = sizes.withColumns({"base": base, "h": _shared(F.col("c"))}).join(sizes.select(F.col("c").alias("base"), F.col("n").alias("nb")), "base", "left")
    taken = F.least("h", F.coalesce("nb", F.lit(0)))
    info = materialise(info.select("c", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")))
    rest = spread_join(own.where(F.col("pos") > _shared(F.col("c"))), info.select("c", "taken"), "c", F.col("pos"))
    rest = rest.select("c", (F.col("pos") - _shared(F.col("c")) + F.col("taken")).alias("pos"), "digest", "n_bytes")
    # ids are divided with rounding to zero, so those of a base lie on both sides of 0 and on one of any other
    heads = own.where((F.col("pos") <= MOST_SHARED) & (F.col("c") % SHARED == 0)).withColumn("to", F.explode(F.array(*[F.try_add("c", F.lit(k).cast("long")) for k in range(1 - SHARED, SHARED)])))
    heads = heads.where((F.col("to") - F.col("to") % SHARED == F.col("c")) & (F.col("pos") <= _shared(F.col("to"))))
    heads = heads.select(F.col("to").alias("c"), "pos", "digest", "n_bytes").join(info.select("c"), "c", "left_semi")
    return rest.unionByName(heads), info.select("c", "len")


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    with scratch(spark):
        nodes = trie(*rebuilt(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
        return materialise(nodes, outlive=True)


#: CRC-32 of a decimal number, bit by bit.
_CRC_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""
OP12_SQL = f"""
WITH own AS (SELECT conv_id AS c, octet_length(encode(coalesce(text, ''))) AS b, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, {_CRC_SQL} % 9 AS h FROM (SELECT DISTINCT c FROM own)),
parts AS (SELECT ids.c, 0 AS part, pos, t, b FROM ids JOIN own ON own.c = ids.c - ids.c % 5 WHERE pos <= h UNION ALL SELECT ids.c, 1, pos, t, b FROM ids JOIN own ON own.c = ids.c WHERE pos > h),
turns AS (SELECT c, t, b, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d FROM parts),
paths AS (SELECT c, d, b, string_agg(t, ',') OVER (PARTITION BY c ORDER BY d) AS k FROM turns UNION ALL SELECT c, 0, 0, '' FROM ids),
lens AS (SELECT c, max(d) AS len FROM paths GROUP BY c),
nodes AS (SELECT k, min(c) AS conv_id, max(d) AS depth, count(*) AS n_convs, max(b) AS b FROM paths GROUP BY k),
ends AS (SELECT k, string_agg(c::VARCHAR, ',' ORDER BY c) AS said FROM paths JOIN lens USING (c) WHERE d = len GROUP BY k),
edges AS (SELECT n.k, p.k AS up, u.conv_id AS parent FROM nodes n JOIN paths p ON p.c = n.conv_id AND p.d = n.depth - 1 JOIN nodes u ON u.k = p.k),
kids AS (SELECT up AS k, count(*) AS n FROM edges GROUP BY 1),
sums AS (SELECT p.k, sum(CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END) AS leaves, sum((n.n_convs - 1) * n.b) AS saved FROM nodes n LEFT JOIN kids ON kids.k = n.k JOIN paths p ON p.c = n.conv_id AND p.d <= n.depth GROUP BY p.k)
SELECT n.conv_id, n.depth::BIGINT AS depth, edges.parent AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(kids.n, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ends.said, '')) AS ends_sha256
FROM nodes n JOIN sums ON sums.k = n.k LEFT JOIN edges ON edges.k = n.k LEFT JOIN kids ON kids.k = n.k LEFT JOIN ends ON ends.k = n.k
"""
