"""Corpus pipeline: toxicity, quality, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows as a Parquet table under the shared checkpoint folder and
rereads it as the next stage's documents. All stages but the last return the
columns of their documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pushback.llm import stages
from pushback.session import cut_lineage

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("quality_classifier", stages.drop_low_quality),
    ("simhash_near_dedup", stages.drop_near_duplicates),
    ("packing", stages.pack_windows),
]

#: Trained models and tokenizers have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
