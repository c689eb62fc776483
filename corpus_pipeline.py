"""Corpus preparation from end to end; every stage's result is written before the next one reads it.

Documents that the quality classifier rejects go; of each class of near
duplicates one stays; documents that hold a benchmark passage go; secrets are
masked; what is left is encoded. All but the last stage return the columns of
``documents``.

NULL texts count as empty ones and stay NULL; empty and very long texts are
handled whole. Rows that agree in key and text are copies, of which one stays;
other rows that share a key are judged one by one. An empty table gives an empty
table. Further columns pass through all stages but the last; ``p_content``,
``p_metadata``, ``p_quality``, ``keep`` and names that begin with an underscore
are reserved for the stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogops.llm import bpe, cotrain, decontaminate, minhash, queries, secrets
from catalogops.sources import stages


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Co-trained on the labels; keeps what it does not reject."""
    judged = cotrain.classify(docs, queries.read(spark, sf_dir, "labels"))
    return judged.where("keep").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Weighted MinHash over five-word shingles at 0.8; the least doc_id of a class stays."""
    return minhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that overlap a benchmark item."""
    return decontaminate.clean(docs, queries.read(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets masked; ``n_chars`` counts the text as it is then."""
    masked = secrets.redact(docs)
    return masked.withColumn(
        "n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the whole texts, decoded again: ``exact`` says that the text came back."""
    path = queries.tokenizer_path()
    encoded = bpe.apply(
        docs.select("doc_id", "lang", "source", "text"),
        bpe.encoding(path), bpe.decoding(path), bpe.comparing("text", "decoded"),
    )
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "exact")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secret_scan),
    ("encoding", encoding),
]
#: No stage can be said in SQL; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = queries.read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, written = stages.stage_at(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if path:
            stages.discard(spark, path)
        path = written
    return docs
