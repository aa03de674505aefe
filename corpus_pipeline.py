"""The corpus pipeline: five stages from raw documents to piece ids.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept
and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import held_out, table, written
from riskspark.llm.decontaminate import drop_contaminated
from riskspark.llm.line_chunks import drop_repeated_chunks
from riskspark.llm.pieces import PieceColumns, encode_documents
from riskspark.llm.queries import PIECES
from riskspark.llm.simhash import keep_one_per_component
from riskspark.llm.toxicity import toxicity_scores


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not call toxic."""
    scored = toxicity_scores(docs, table(spark, sf_dir, "labels"), lambda i: ~held_out(i, 4, 2), threshold=0.3)
    return scored.where("predicted = 0").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the chunks of sentences that an earlier place holds; ``n_chars`` follows the text."""
    clean = drop_repeated_chunks(docs, window=2, min_chars=20, unit="sentence")
    count = F.when(F.col("lines_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", count.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints chain within 3 bits."""
    return keep_one_per_component(docs, shingle=3, max_distance=3).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), min_match=5, threshold=0.8).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids."""
    return encode_documents(docs, PieceColumns(spark, PIECES))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("encode", encode)]

#: The toxicity model, the fingerprints' XXH64 and the piece model have no DuckDB form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
