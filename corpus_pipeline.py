"""A cleaning pipeline over the documents: toxicity, quality rules, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tilewright.llm import minhash, packing, quality, toxicity
from tilewright.llm.common import shared_dir, table
from tilewright.llm.queries import toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5, by a model learned from docs and the labels table."""
    return toxicity.reject_toxic(docs, toxicity_model(docs.select("doc_id", "text"), table(spark, sf_dir, "labels")))


def apply_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without lines over the limit; n_chars follows the text."""
    kept = quality.apply_rules(docs, **quality.BOUNDED)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked at a similarity of 0.8 or more over five words."""
    return minhash.keep_first(docs, shingle=5, percent=80, bands=36, rows=5)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of every document with their place in sequences of at most 1024 tokens."""
    packed = packing.pack(docs, limit=1024, end_id=2, keep_ids=False)
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("quality rules", apply_quality), ("near duplicates", drop_near_duplicates), ("packing", pack)]

#: Learned scores, shingle sets, tokens and best fit have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/tilewright/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
