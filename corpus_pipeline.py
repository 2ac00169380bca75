"""Corpus pipeline: documents filtered, deduplicated, mixed and encoded in five stages.

Every stage takes (spark, docs, sf_dir) and works on all rows of its predecessor, whose
result is written as Parquet and read again. All stages but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroad.llm import common
from tallyroad.llm.jaccard_join import one_of_each
from tallyroad.llm.line_dedup import line_dedup
from tallyroad.llm.mixing import mix
from tallyroad.llm.sentencepiece_codec import encode_documents
from tallyroad.llm.toxicity import toxicity_scores


def _columns(names: list[str], made: dict) -> list:
    """The columns of documents: those made by a stage, the rest from ``carried``."""
    return [made.get(c, F.col("carried").getField(c)).alias(c) for c in names]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays under the threshold of their language; each row by its own score."""
    scores = toxicity_scores(docs, common.read(spark, sf_dir, "labels"), other=tuple(c for c in docs.columns if c != "text"))
    return scores.where(~F.col("rejected")).select(*_columns(docs.columns, {"text": F.col("text")}))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others repeat; n_chars is counted anew."""
    out = line_dedup(docs, other=tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars")))
    return out.select(*_columns(docs.columns, {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.char_length("text").cast("long")}))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the smallest doc_id."""
    return one_of_each(docs, 5, 80, 100)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by their calibrated probabilities."""
    return mix(docs, other=tuple(docs.columns)).where("selected").select(*_columns(docs.columns, {}))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document that is left."""
    return encode_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_deduplication", line_deduplication),
    ("near_duplicates", near_duplicates),
    ("source_mixing", source_mixing),
    ("sentencepiece", sentencepiece),
]

#: The fitted classifier and the search for the best pieces can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``."""
    docs = common.read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = common.materialize(docs, name)
    return docs
