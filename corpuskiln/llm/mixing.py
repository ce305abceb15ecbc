"""Mixing sources to target weights by capped water-filling.

Every source gets its share of the total by weight, but no more than ``max_epochs`` times what it holds; what a clamped
source can't use goes to the others by weight until none is above its cap. Sorted by cap per unit of weight, the first
source that needn't be clamped settles the level, so there is one pass over the sources and no loop.

A source's target is taken as whole repetitions of all its documents and one partial repetition: its documents in the
order of a seeded hash, as far as the target reaches. To find where that is, sizes are summed by (source, hash bucket)
with partial sums before the shuffle; the one bucket where a source's target falls is dealt to buckets in turn, and only
one of those, a 16-millionth of the source, is looked at row by row. The
decision is one row per source (repetitions, last hash taken), so each document is decided on its own and reruns agree.

Defined results: a null text has size 0; null is a source, the last; sources of size 0 get target 0 and take nothing;
a source at its cap takes exactly ``max_epochs`` of each document, empty ones included;
rows that share an id are taken or left together; words of texts of any length are counted; ties in the draw are those of one
id; an empty table gives an empty table. A source's taken words differ
from its target by less than the words of the rows of one id. All of it is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.llm.common import materialise

#: Hash bits of a bucket, at each of LEVELS levels.
BUCKET_BITS, LEVELS = 12, 2
HASH_BITS = 60


def word_count(text: Column) -> Column:
    """Maximal runs of characters other than space, tab, line feed, vertical tab, form feed and carriage return."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def seeded_hash(id_col: Column, seed: int) -> Column:
    """60 bits of the MD5 of seed and id, which other engines can compute as well."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.lit("")))), 1, HASH_BITS // 4), 16, 10).cast("long")


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Adds weight to one row per source: the given ones over and over, sources by code point, null last."""
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (nth % len(weights) + 1).cast("int")))


def water_fill(sources: DataFrame, max_epochs: int = 3) -> DataFrame:
    """sources (source, source_size, weight), one row each: adds target. Weights are positive whole numbers.

    The windows below run in one task: their input is one row per source, after all aggregation.
    """
    everyone = Window.partitionBy()
    order = Window.orderBy(F.col("__cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    ranked = sources.withColumn("__cap", F.col("source_size") * max_epochs).withColumns(
        {
            "__total": F.sum("source_size").over(everyone),
            "__clamped": F.coalesce(F.sum("__cap").over(before), F.lit(0)),
            "__weights": F.sum("weight").over(rest),
        }
    )
    level = (F.col("__total") - F.col("__clamped")).cast("double") / F.col("__weights")
    fits = level * F.col("weight") <= F.col("__cap")
    settled = ranked.withColumn("__level", F.max(F.when(fits, level)).over(everyone))  # clamping more than needed lowers it
    poured = F.col("__level") * F.col("weight")
    target = F.when(F.col("__level").isNull() | (poured > F.col("__cap")), F.col("__cap").cast("double")).otherwise(poured)
    return settled.select("source", "source_size", "weight", target.alias("target"))


def _edge(sums: DataFrame) -> DataFrame:
    """sums (source, bucket, size, want, before): the bucket of each source in which its running total passes what is wanted."""
    running = F.sum("size").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    at = sums.withColumn("before", F.col("before") + F.coalesce(running, F.lit(0)))
    return at.where("before <= want AND want < before + size").select("source", "bucket", "before", "want")


def mix_plan(sized: DataFrame, weigh=cyclic_weights, max_epochs: int = 3) -> DataFrame:
    """sized (source, size, h): one row per source with its target, whole repetitions and the last hash taken once more."""
    null_safe = lambda x, y: x["source"].eqNullSafe(y["source"])
    bucket_at = lambda level: F.shiftright("h", HASH_BITS - BUCKET_BITS * (level + 1))
    sums = materialise(sized.groupBy("source", bucket_at(0).alias("bucket")).agg(F.sum("size").alias("size")))
    sources = water_fill(weigh(sums.groupBy("source").agg(F.sum("size").alias("source_size"))), max_epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = materialise(sources.withColumn("whole", F.floor(ratio).cast("long")).withColumn("want", F.col("target") - F.col("whole") * F.col("source_size")))
    # only sources that take part of a further repetition look for its end
    wanted = sources.where("want > 0").select("source", "want", F.lit(0).cast("long").alias("before"))
    edge = materialise(_edge(sums.join(wanted, null_safe(sums, wanted)).select(sums["source"], "bucket", "size", "want", "before")))
    for level in range(1, LEVELS):
        rows = sized.withColumn("bucket", bucket_at(level - 1))
        inside = rows.join(edge, null_safe(rows, edge) & (rows["bucket"] == edge["bucket"])).select(rows["source"], "h", rows["size"], "want", "before")
        edge = materialise(_edge(inside.groupBy("source", "want", "before", bucket_at(level).alias("bucket")).agg(F.sum("size").alias("size"))))
    rows = sized.withColumn("bucket", bucket_at(LEVELS - 1)).groupBy("source", "bucket", "h").agg(F.sum("size").alias("size"))
    near = rows.join(edge, null_safe(rows, edge) & (rows["bucket"] == edge["bucket"])).select(rows["source"], "h", rows["size"], "before", "want")
    upto = F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("h").rowsBetween(Window.unboundedPreceding, 0))
    middle = upto - F.col("size") / 2.0
    cuts = near.withColumn("middle", middle).groupBy("source").agg(F.max(F.when(F.col("middle") <= F.col("want"), F.col("h"))).alias("cut"), F.min("h").alias("first"))
    # before the bucket's first row if none of its rows is taken; a source without an edge takes no part of another repetition
    return sources.join(cuts, null_safe(sources, cuts), "left").select(
        sources["source"], "source_size", "weight", "target", "whole",
        F.coalesce("cut", F.col("first") - 1, F.lit(-1)).cast("long").alias("cut"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, weigh=cyclic_weights, max_epochs: int = 3) -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies, taken."""
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), seeded_hash(F.col(id_col), seed).alias("h"))
    sized = materialise(sized)
    plan = materialise(mix_plan(sized.select("source", "size", "h"), weigh, max_epochs))
    copies = F.col("whole") + (F.col("h") <= F.col("cut")).cast("long")
    joined = sized.join(plan, sized["source"].eqNullSafe(plan["source"])).select(F.col("id").alias(id_col), sized["source"].alias(source_col), "size", "source_size", "target", copies.alias("copies"))
    return joined.withColumn("taken", F.col("size") * F.col("copies"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, weigh=cyclic_weights, max_epochs: int = 3) -> DataFrame:
    """The documents of the mix with the columns they came with, each as many times as it is taken."""
    sized = docs.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), seeded_hash(F.col(id_col), seed).alias("h"))
    plan = materialise(mix_plan(materialise(sized), weigh, max_epochs))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(source_col).alias("__source"), seeded_hash(F.col(id_col), seed).alias("__h"))
    copies = (F.col("whole") + (F.col("__h") <= F.col("cut")).cast("long")).cast("int")
    taken = rows.join(plan, rows["__source"].eqNullSafe(plan["source"])).withColumn("__copies", copies).where("__copies > 0")
    return taken.select("__row", F.explode(F.sequence(F.lit(1), "__copies"))).select("__row.*")


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken", "copies")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight, 3 * source_size AS cap FROM s),
r AS (SELECT *, sum(source_size) OVER ()::BIGINT AS total,
        coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS clamped,
        sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS weights FROM w),
l AS (SELECT *, (total - clamped)::DOUBLE / weights AS lv FROM r),
m AS (SELECT *, max(CASE WHEN lv * weight <= cap THEN lv END) OVER () AS level FROM l),
t AS (SELECT source, source_size, CASE WHEN level IS NULL OR level * weight > cap THEN cap::DOUBLE ELSE level * weight END AS target FROM m),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
k AS (SELECT source, h, sum(size)::BIGINT AS size FROM d GROUP BY source, h),
c AS (SELECT k.source, h, sum(k.size) OVER (PARTITION BY k.source ORDER BY h ROWS UNBOUNDED PRECEDING) - k.size / 2.0 AS middle FROM k),
x AS (SELECT p.source, max(h) AS cut FROM p JOIN c ON p.source IS NOT DISTINCT FROM c.source
      WHERE c.middle <= p.target - p.whole * p.source_size AND p.target - p.whole * p.source_size > 0 GROUP BY p.source)
SELECT d.doc_id, d.size, p.source_size, p.target, d.size * (p.whole + CASE WHEN d.h <= coalesce(x.cut, -1) THEN 1 ELSE 0 END) AS taken,
       p.whole + CASE WHEN d.h <= coalesce(x.cut, -1) THEN 1 ELSE 0 END AS copies
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN x ON d.source IS NOT DISTINCT FROM x.source
"""
