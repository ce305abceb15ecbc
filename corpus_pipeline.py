"""The corpus pipeline: documents without toxic ones, copies and near copies, mixed to target weights, as token ids.

Each stage takes the documents its predecessor kept and returns them with the columns of ``documents``; the last returns
doc_id, n_ids, ids and round_trip, one row for each time a document is in the mix.

Defined results, stage by stage as the operators state them: a null text counts as empty everywhere, and all empty documents are
copies of one another, so one stays, takes no words and is in the mix or not as a whole; texts of any length are read whole; of
copies the largest id stays, of near copies the least; a null id comes last; rows that are repeated are copies; a null source
is a source, the last; without labels nothing is toxic; other columns go through the stages but for the last; empty tables
give an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpuskiln.llm import exact_dedup, jaccard, mixing, pieces, toxicity
from corpuskiln.llm.common import materialise, scratch


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.piece_encode(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("ngram_jaccard_join", without_near_copies),
    ("mixing", mixed),
    ("sentencepiece", encoded),
]

#: Not expressible: the first, third and last stages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        with scratch(spark):  # what a stage has written goes once its documents are
            docs = materialise(stage(spark, docs, sf_dir), outlive=True)
    return STAGES[-1][1](spark, docs, sf_dir)
