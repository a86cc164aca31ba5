"""The corpus pipeline: documents without toxic and poor ones and near copies, packed for training.

``STAGES`` are (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame. ``run`` writes each stage's result as Parquet in
the shared folder and rereads it as the next stage's documents. All stages
but the last return the columns of ``documents``, and read no others, so
extra columns of any name are ignored.

Defined results: a null text counts as empty; an empty table gives an empty
result; rows that repeat an id and its text are copies, of which one stays;
a document with a null id is never taken for a copy.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import remove, table, write_table
from blotter.llm.path_join import near_duplicates
from blotter.llm.quality import score_quality
from blotter.llm.token_packing import pack
from blotter.llm.toxicity import score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
VOCABULARY = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    docs = docs.select(*COLUMNS)
    scored = score_toxicity(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"), keep=tuple(COLUMNS))
    return scored.filter("predicted = 0").select(*COLUMNS)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior probability of good quality is 0.5 or more."""
    docs = docs.select(*COLUMNS)
    scored = score_quality(docs, table(spark, sf_dir, "labels", "doc_id", "quality"), F.col("source"),
                           F.concat_ws("/", "source", "lang"), COLUMNS)
    return scored.filter("good").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates."""
    docs = docs.select(*COLUMNS)
    stay = near_duplicates(docs, width=5, percent=80).filter("kept").select(F.col("doc_id").alias("stay_id")).distinct()
    # Both steps need rows of an id together: one shuffle of the texts, which a null-safe join would make two.
    # No row without an id is a copy.
    kept = docs.join(stay, F.col("doc_id") == F.col("stay_id"), "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.filter("doc_id IS NULL").dropDuplicates(["doc_id", "text"])).select(*COLUMNS)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences: one row per piece."""
    return pack(docs.select(*COLUMNS), public_tokenizers.path(VOCABULARY), added=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_near_copies),
    ("packing", pack_tokens),
]

# Two of the stages are trained models: SQL can't express their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that all stages keep."""
    docs, before = table(spark, sf_dir, "documents", *COLUMNS), None
    for name, stage in STAGES:
        docs, at = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            remove(spark, before)
        before = at
    return docs
