"""Small helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuskiln.sources.shared import materialise, scratch, shared_dir  # noqa: F401  for the operators

#: Sub-groups that a group of equal keys is dealt to before its rows are brought together.
SALTS = 64


def _numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """rows with rank: numbers that increase in the given order, no two alike. Equal rows are dealt to many tasks."""
    spread = rows.withColumn("__n", F.monotonically_increasing_id())
    dealt = spread.repartitionByRange(*order, F.col("__n")).sortWithinPartitions(*order, F.col("__n"))
    return dealt.drop("__n").withColumn("rank", F.monotonically_increasing_id())


def ranked_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, rank) with null texts empty: a whole number that orders documents by id, nulls last.

    Ids that are whole numbers (below 2**62) are their own ranks, so rows that share one count as one document. Rows of a
    null id are numbered after them, by a hash of their text, and so are all rows where ids are of another type, by id and
    then by that hash: those rows are written to the shared folder once, so that all stages see the same numbers."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        return materialise(_numbered(rows, F.col("id").asc_nulls_last(), F.xxhash64("text")))
    last = materialise(_numbered(rows.where("id IS NULL"), F.xxhash64("text")))
    return rows.where("id IS NOT NULL").withColumn("rank", F.col("id").cast("long")).unionByName(last.withColumn("rank", F.col("rank") + F.lit(1 << 62)))


def salt_of(*cols: Column, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int")


#: An aggregate over the column salt, and its way back: which salts a group's rows have, as the bits of a long.
SALT_MASK = "bit_or(shiftleft(1L, salt))"


def unmask(groups: DataFrame) -> DataFrame:
    """groups with salts, a SALT_MASK: a row for each salt. Joined on (key, salt), no task gets a whole hot group."""
    return groups.withColumn("salt", F.explode(F.expr(f"filter(sequence(0, {SALTS - 1}), s -> shiftright(salts, s) & 1 = 1)"))).drop("salts")


def one_row_per_key(df: DataFrame, keys: list[str], order: list[Column], spread: Column, salts: int = SALTS) -> DataFrame:
    """The first row of each key in the given order; of rows equal in it, any one.

    First within (key, salt), then among the at most ``salts`` rows left of a key: no task gets a whole hot group.
    """
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    first = Window.partitionBy(*keys, "__salt").orderBy(*order)
    heads = salted.withColumn("__nth", F.row_number().over(first)).where("__nth = 1")
    last = Window.partitionBy(*keys).orderBy(*order)
    return heads.withColumn("__nth", F.row_number().over(last)).where("__nth = 1").drop("__nth", "__salt")


#: Bits of a bit_filter at most: 32 MB.
MOST_BITS = 1 << 28


def bit_filter(keys: DataFrame, col: str, n: int):
    """A bit set, as an array of 64-bit words, in which the bit ``pmod(value, bits)`` of each of the column's longs is set.

    It has 16 bits for each of the n keys counted, and MOST_BITS at most, so it can go to all tasks. It lets through what
    it can't rule out: an exact join must follow, which at any size gives the result; beyond MOST_BITS the set fills up
    and saves that join less and less."""
    import numpy as np

    bits = min(MOST_BITS, 1 << max(16, (16 * n).bit_length()))
    bit = keys.select(F.pmod(F.col(col), F.lit(bits)).alias("bit"))
    words = bit.groupBy(F.expr("bit DIV 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(bit % 64 AS INT)))").alias("set")).toArrow()  # at most bits / 64 rows
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy()] = words["set"].to_numpy()
    return out.view(np.uint64)


def may_hold(bits, values):
    """Which of the values (64-bit numbers) a bit_filter can't rule out."""
    import numpy as np

    at = values.astype(np.int64) % (len(bits) * 64)
    return bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1) > 0


#: Rows of a table that goes to all tasks at most, 16 bytes each; a larger one is joined, with the same results.
MOST_ROWS = 1 << 20
#: Rows that share one part of a table in that join, and the bytes of their last column beyond which a block ends early.
BLOCK_ROWS, BLOCK_BYTES = 1024, 16 << 20


def slices(batch, column: int, rows: int = 500, size: int = BLOCK_BYTES) -> Iterator:
    """An Arrow batch in slices of at most so many rows and bytes of a text column; a larger text is a slice of its own."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    at = total = 0
    for k, n in enumerate(sizes):
        if k > at and (k - at >= rows or total + n > size):
            yield batch.slice(at, k - at)
            at, total = k, 0
        total += n
    if at < len(sizes):
        yield batch.slice(at)


def in_blocks(rows: DataFrame) -> DataFrame:
    """rows with __block, a number: neighbours share one, up to BLOCK_ROWS of them or BLOCK_BYTES of
    their last column, if that is text; a larger text has a block of its own."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark import TaskContext

    def deal(batches):
        block = TaskContext.get().partitionId() << 40
        n = size = 0
        for b in batches:
            out = np.empty(b.num_rows, np.int64)
            last = b.column(b.num_columns - 1)
            sizes = pc.fill_null(pc.binary_length(last), 0).to_pylist() if pa.types.is_string(last.type) else [0] * len(last)
            for k, length in enumerate(sizes):
                if n and (n >= BLOCK_ROWS or size + length > BLOCK_BYTES):
                    block, n, size = block + 1, 0, 0
                n, size, out[k] = n + 1, size + length, block
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], [*b.schema.names, "__block"])

    return rows.mapInArrow(deal, T.StructType([*rows.schema.fields, T.StructField("__block", T.LongType())]))


def with_table(rows: DataFrame, table: DataFrame, keys_of: Callable, apply: Callable, schema: str, most: int | None = None) -> DataFrame:
    """rows through ``apply(batch, keys, values)``, where keys and values are columns of table (key long, and a number as
    value, one row a key), sorted by key; they hold at least those of ``keys_of(batch)``.

    A table of up to ``most`` rows, which are counted, goes to all tasks. Of a larger one, each block of rows gets what it
    asks for: by a join of its distinct keys with the table, brought together with the block."""
    import numpy as np
    import pyarrow as pa

    spark = rows.sparkSession
    columns = rows.columns
    if table.count() <= (MOST_ROWS if most is None else most):
        whole = table.toArrow()
        keys = whole["key"].to_numpy()
        order = np.argsort(keys)
        shared = spark.sparkContext.broadcast((keys[order], whole["value"].to_numpy()[order]))  # counted above

        def run(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK_ROWS):
                    yield apply(batch.slice(at, BLOCK_ROWS), *shared.value)

        return rows.mapInArrow(run, schema)
    blocks = materialise(in_blocks(rows))

    def ask(batches):
        for batch in batches:
            block = batch.column(batch.num_columns - 1).to_numpy()
            for b in np.unique(block):
                keys = np.unique(keys_of(batch.drop_columns(["__block"]).filter(pa.array(block == b))))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), b)), pa.array(keys)], ["__block", "key"])

    wanted = blocks.mapInArrow(ask, "__block long, key long").distinct()
    found = spread_join(wanted, table.select("key", "value"), "key", F.col("__block")).select("__block", "key", "value")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("key")
        batch = pa.Table.from_arrays([left[c].combine_chunks() for c in columns], columns).combine_chunks().to_batches()
        return pa.Table.from_batches([apply(b, right["key"].to_numpy(), right["value"].to_numpy()) for b in batch])

    return blocks.groupBy("__block").cogroup(found.groupBy("__block")).applyInArrow(meet, schema)


def values_at(keys, values, wanted, missing=0):
    """The values of the wanted keys, an array of any shape; keys ascend."""
    import numpy as np

    out = np.full(wanted.shape, missing, values.dtype)
    if len(keys):
        bits = max(10, len(keys).bit_length() + 3)  # most keys that aren't there are found out by their first bits
        there = np.zeros(1 << bits, bool)
        there[keys >> (64 - bits)] = True
        asked = wanted[near := there[wanted >> (64 - bits)]]
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        out[near] = np.where(keys[at] == asked, values[at], missing)
    return out


def summed(parts: Iterable, classes: int, most: int = 1 << 20) -> Iterator:
    """parts (keys, class) to (distinct keys, their counts by class), a task's own sums, given out whenever there are more
    than ``most`` of them."""
    import numpy as np

    keys, counts = np.zeros(0, np.int64), np.zeros((0, classes), np.int64)
    waiting: list = []
    size = 0

    def merged():
        own = [np.unique(k, return_counts=True) for k, _ in waiting]
        new = [np.zeros((len(k), classes), np.int64) for k, _ in own]
        for (_, n), (_, c), to in zip(own, waiting, new):
            to[:, c] = n
        every, where = np.unique(np.concatenate([keys, *[k for k, _ in own]]), return_inverse=True)
        out = np.zeros((len(every), classes), np.int64)
        np.add.at(out, where, np.concatenate([counts, *new]))
        return every, out

    for part in parts:
        waiting.append(part)
        size += len(part[0])
        if size > most:
            keys, counts = merged()
            waiting, size = [], 0
            if len(keys) > most:
                yield keys, counts
                keys, counts = keys[:0], counts[:0]
    keys, counts = merged()
    if len(keys):
        yield keys, counts


def spread_join(big: DataFrame, small: DataFrame, key: str | list[str], spread: Column, how: str = "inner") -> DataFrame:
    """big with the columns of small, which has one row a key: a key's rows are dealt to SALTS tasks by spread, and small's
    row goes to those that have any. small may have salts, a SALT_MASK over that spread, of its keys already."""
    keys = [key] if isinstance(key, str) else key
    salted = big.withColumn("salt", salt_of(spread))
    if "salts" not in small.columns:
        small = small.join(salted.groupBy(*keys).agg(F.expr(SALT_MASK).alias("salts")), keys)
    return salted.join(unmask(small), [*keys, "salt"], how).drop("salt")


_HALF = 0xFFFFFFFF


def _drawn(n: Column, nth: int) -> Column:
    """Another number for each: a bijection of 64-bit numbers that gives them a new order for every nth."""
    low, high = n.bitwiseAND(_HALF), F.shiftrightunsigned(n, 32)
    high = high.bitwiseXOR(F.xxhash64(low, F.lit(nth)).bitwiseAND(_HALF))
    low = low.bitwiseXOR(F.xxhash64(high, F.lit(nth)).bitwiseAND(_HALF))
    return F.shiftleft(high, 32).bitwiseOR(low)


def _undrawn(n: Column, nth: int) -> Column:
    low, high = n.bitwiseAND(_HALF), F.shiftrightunsigned(n, 32)
    low = low.bitwiseXOR(F.xxhash64(high, F.lit(nth)).bitwiseAND(_HALF))
    high = high.bitwiseXOR(F.xxhash64(low, F.lit(nth)).bitwiseAND(_HALF))
    return F.shiftleft(high, 32).bitwiseOR(low)


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of whole numbers: one node of each connected component as its root, for the nodes that have edges.

    Contraction: each node goes to the least one, in an order drawn anew every round, within two steps; edges between the
    nodes left over are the next round's. Paths shrink by a constant share a round and stars at once, so rounds grow with
    the logarithm of the input. Minima are group-bys of numbers with partial sums, and where a node's number goes to all its
    edges they are dealt to SALTS tasks by their other ends: no task gets a hub's edges. What a round leaves is written to the shared folder.
    """
    with scratch(edges.sparkSession):
        return _connected(edges, a, b)


def _connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    left = materialise(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b").distinct())
    steps: list[DataFrame] = []
    while not left.isEmpty():
        nth = len(steps)
        both = left.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(left.select(F.col("b").alias("node"), F.col("a").alias("other")))
        ends = both.groupBy("node").agg(F.min(_drawn(F.col("other"), nth)).alias("m"), F.expr(SALT_MASK.replace("salt)", f"pmod(xxhash64(other), {SALTS}))")).alias("salts"))
        near = materialise(ends.select("node", F.least("m", _drawn(F.col("node"), nth)).alias("m"), "salts"))
        met = spread_join(both, near.withColumnRenamed("node", "other"), "other", F.col("node"))
        far = met.groupBy("node").agg(_undrawn(F.min("m"), nth).alias("to"))
        step = materialise(far.join(near.select("node", "salts"), "node"))
        named = spread_join(left, step.withColumnsRenamed({"node": "a", "to": "x"}), "a", F.col("b"))
        named = spread_join(named, step.withColumnsRenamed({"node": "b", "to": "y"}), "b", F.col("a"))
        left = materialise(named.select(F.col("x").alias("a"), F.col("y").alias("b")).where("a != b").distinct())
        steps.append(step.select("node", "to"))
    if not steps:
        return edges.select(F.col(a).alias("node"), F.col(a).alias("root")).limit(0)
    roots = steps.pop().select("node", F.col("to").alias("root"))
    while steps:
        known = spread_join(steps.pop(), roots.withColumnRenamed("node", "to"), "to", F.col("node"), "left")
        roots = known.select("node", F.coalesce("root", "to").alias("root"))
    return materialise(roots, outlive=True)
