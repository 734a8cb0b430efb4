"""From raw documents to a mixed training corpus, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and
reread as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from netvitals.llm.exact_dedup import exact_dedup
from netvitals.llm.mixing import mixed_documents
from netvitals.llm.near_dedup import near_dedup
from netvitals.llm.queries import PIECES
from netvitals.llm.sentencepiece_codec import encode_documents
from netvitals.llm.toxicity import reject_toxic
from netvitals.plans.shared import fresh_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose deobfuscated text scores below 0.5 under the model of the labels."""
    return reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each content, the one with the largest id."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return near_dedup(docs, shingle=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights: copies for full epochs, a cut row at each budget."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in the place of texts, with the check that they decode to them."""
    return encode_documents(docs, PIECES)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mixing),
    ("sentencepiece", encode),
]

#: Near duplicates and learnt scores are not expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
