"""Exact dedup by sorting content.

Sampled splitters range-partition the normalised texts, an external sort places equal ones next to each other, and a
window compares each row's whole key with its neighbour's. All of it is DataFrame code.

The splitters are taken from (first characters, hash, salt) and never from whole texts: what the sampling brings to the
driver has a fixed width, texts that begin alike are dealt apart by the hash, and a group of equal texts is dealt apart
by the salt, so one group may hold any share of the rows. The at most SALTS pieces of a group then meet as narrow rows
under their SHA-256.

Defined results: a null text counts as empty; of equal texts the row with the largest (or smallest) id stays; a null id
counts as less than any other (as greater for ``keep="smallest"``); of repeated rows with one id and one text exactly
one stays; texts of any length are compared whole; an empty table gives an empty table; other columns of the input are ignored by ``exact_groups`` and handed
through by ``drop_exact_copies``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.llm.common import SALTS, materialise, salt_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters beyond A-Z that may have a lower case, and characters that this Java doesn't know but lower() may.
OTHER_CAPITALS = r"[[\p{javaUpperCase}\p{Lu}\p{Lt}\p{Cn}]&&[^\x00-\x7F]]"
#: Characters of the normalised text that a splitter holds.
PREFIX = 48


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z alone. lower() does the same, faster, where a text has no other letter with a lower case."""
    return F.when(text.rlike(OTHER_CAPITALS), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def _sorted(rows: DataFrame, keep: str, salts: int) -> DataFrame:
    """rows has __id and __norm; adds the rank within a piece, and the piece's best id and size."""
    keyed = rows.select("*", F.substring("__norm", 1, PREFIX).alias("__prefix"), F.xxhash64("__norm").alias("__tie"), salt_of(F.col("__id"), salts=salts).alias("__salt"))
    dealt = keyed.repartitionByRange("__prefix", "__tie", "__salt")
    piece = Window.partitionBy("__prefix", "__tie", "__salt", "__norm")
    best, order = (F.max, F.col("__id").desc_nulls_last()) if keep == "largest" else (F.min, F.col("__id").asc_nulls_last())
    return dealt.withColumns({"__rank": F.row_number().over(piece.orderBy(order)), "__best": best("__id").over(piece), "__n": F.count(F.lit(1)).over(piece)})


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", salts: int = SALTS) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256 of the normalised text."""
    rows = docs.select(F.col(id_col).alias("__id"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("__norm"))
    narrow = materialise(_sorted(rows, keep, salts).select("__id", "__salt", "__rank", "__best", "__n", F.unhex(F.sha2("__norm", 256)).alias("__sha")))
    best = F.max if keep == "largest" else F.min
    groups = narrow.where("__rank = 1").groupBy("__sha").agg(best("__best").alias("keep_id"), F.sum("__n").alias("group_size"), F.collect_list("__salt").alias("__salts"))
    pieces = groups.select("__sha", "keep_id", "group_size", F.explode("__salts").alias("__salt"))
    return narrow.join(pieces, ["__sha", "__salt"]).select(
        F.col("__id").alias(id_col), "keep_id", "group_size",
        ((F.col("__rank") == 1) & F.col("__id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("__sha")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", salts: int = SALTS) -> DataFrame:
    """The documents that stay, with the columns they came with."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(id_col).alias("__id"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("__norm"))
    heads = _sorted(rows, keep, salts).where("__rank = 1").select("__row", "__id", F.unhex(F.sha2("__norm", 256)).alias("__sha"))
    order = F.col("__id").desc_nulls_last() if keep == "largest" else F.col("__id").asc_nulls_last()
    stays = heads.withColumn("__nth", F.row_number().over(Window.partitionBy("__sha").orderBy(order))).where("__nth = 1")
    return stays.select("__row.*")


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP1_SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g USING (norm)
"""
