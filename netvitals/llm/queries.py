"""Registered queries of the operators in this package, each over its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netvitals.llm.embedding_dedup import embedding_groups
from netvitals.llm.exact_dedup import exact_groups
from netvitals.llm.language_id import identify_corpus
from netvitals.llm.lexical_search import search
from netvitals.llm.licenses import scan_licenses
from netvitals.llm.mixing import mix
from netvitals.llm.near_dedup import near_groups
from netvitals.llm.oracles import ORACLES
from netvitals.llm.periodic_runs import run_digests
from netvitals.llm.preference import alternate_answers, preference_rows
from netvitals.llm.sentencepiece_codec import encode_documents
from netvitals.llm.substring_dedup import repeated_passages
from netvitals.llm.toxicity import score_documents
from netvitals.llm.url_filter import judge_urls, query_rules


#: Vocabulary files are never copied here; the path is a parameter of the operators.
PIECES = os.environ.get("SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_preference_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against itself with its neighbour's answer in the place of one of its own;
    spans as text (first-last, comma-separated)."""
    rows = preference_rows(alternate_answers(table(spark, sf_dir, "conversations")))

    def shown(name):
        parts = F.transform(name, lambda s: F.concat_ws("-", s["first"], s["last"]))
        return F.array_join(parts, ",").alias(name)

    return rows.select(
        "conv_id", "n_common", "prompt", "chosen", "rejected", shown("chosen_spans"), shown("rejected_spans")
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known license notices in every text."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of 3-word shingles, linked at a Jaccard similarity of 0.85."""
    return near_groups(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unchanged texts; the largest doc_id stays."""
    return exact_groups(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on the labelled rows outside the held-out fold, applied to every text."""
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine 0.9 over all vectors, labels unread."""
    return embedding_groups(table(spark, sf_dir, "embeddings"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether decoding them gives it back."""
    return encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), PIECES)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all pages (markup, address, host, text) and documents (text, source)."""
    return identify_corpus(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that nearly repeat one of an earlier document."""
    return repeated_passages(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 3, 1, 2 over sources, 150 % of all words, two epochs at most."""
    return mix(table(spark, sf_dir, "documents"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every address by five rules, the others by the trust and distrust of their hosts."""
    judged = judge_urls(table(spark, sf_dir, "pages"), query_rules(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for the terms of each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of 24 words and three periods and more, a tenth of the documents made periodic."""
    return run_digests(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_preference_chat": op1_preference_chat,
    "op2_license_scan": op2_license_scan,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_language_id": op8_language_id,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_mixing": op10_mixing,
    "op11_url_filter": op11_url_filter,
    "op12_lexical_search": op12_lexical_search,
    "op13_periodic_runs": op13_periodic_runs,
}

__all__ = ["QUERIES", "ORACLES"]
