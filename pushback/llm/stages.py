"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

The filters return the columns of ``docs``; a null text is an empty one. The
score column within them has a name that the documents do not use.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pushback.llm import packing, quality, simhash, toxicity
from pushback.llm.common import free_name, id_hash, table
from pushback.session import make_importable

def toxicity_train():
    return id_hash("doc_id") % 4 != 2


def quality_train():
    return id_hash("doc_id") % 3 != 1


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is under the threshold."""
    make_importable(spark)
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"), train=toxicity_train())
    score = free_name(docs, "_score")
    return toxicity.score_documents(docs, model, score_col=score).where(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose quality score reaches the threshold."""
    make_importable(spark)
    model = quality.trained(docs, table(spark, sf_dir, "labels"), train=quality_train())
    score = free_name(docs, "_score")
    return quality.score_documents(docs, model, score_col=score).where(F.col(score) >= quality.THRESHOLD).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group."""
    make_importable(spark)
    return simhash.drop_near_duplicates(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    make_importable(spark)
    cut = packing.pieces(docs, path=public_tokenizers.path("byte_bpe_50k.json"))
    cut = cut.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.pack(cut, order=["doc_id", "start", "ids_crc32"])
