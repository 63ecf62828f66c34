"""A corpus pipeline: toxicity, line dedup, near-duplicate documents, source mixing, sampled pieces.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the last return the columns of
``documents``; other columns of ``docs`` are carried along.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens.llm import lines, mixing, pieces, simhash, toxicity
from catalens.staging import shared_folder
from catalog_queries.registry import query

PIECE_MODEL = pieces.PIECE_MODEL
PIECE_CACHE_BYTES = 50 << 20  # fixed value: lattices a worker keeps in the last stage


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go; the classifier learns from ``labels`` of rows outside the held-out fifth."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; ``n_chars`` is that of the remaining text."""
    return lines.drop_repeated_lines(docs, n_chars="n_chars")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by SimHash (three-word shingles, at most two bits) the first one stays."""
    return simhash.drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them: sources get words in the ratio 1, 2, 3, repeating.

    Rows are drawn by id and text, so that those with a null or repeated id are told apart unless they are equal.
    """
    rows = docs.select(
        F.struct("*").alias("doc"), F.xxhash64("doc_id", "text").alias("id"), F.array("source").alias("sources"), mixing.words_in("text").alias("size")
    )
    mixed = mixing.mix(rows, "sources", "size", row_id="id")
    return mixed.select("doc", F.explode(F.sequence(F.lit(0), F.col("repeats"))).alias("copy")).filter("copy > 0").select("doc.*")


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids): a segmentation into pieces sampled with the document's id as seed.

    An executor still holds what the stages before took, so its workers keep fewer lattices.
    """
    return pieces.encode(docs, PIECE_MODEL, cache_bytes=PIECE_CACHE_BYTES)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("source_mixing", mixing_stage),
    ("piece_encoding", pieces_stage),
]

#: A trained classifier, SimHash, hash selection and sampling have no SQL form: tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/catalens-pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


query("pipeline")(run)
