"""The corpus pipeline: from raw documents to token ids, a stage at a time.

Each stage takes (spark, docs, sf_dir), works on all rows of its predecessor and is
written as Parquet before the next one reads it.  All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstone.llm import bpe, decontaminate, quality, simhash, toxicity
from turnstone.llm.common import read, staged
from turnstone.llm.queries import byte_bpe, token_digests


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not predict to be toxic."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col("predicted") == 0).select(docs.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold the fixed limits and that the quality model keeps."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    return quality.judge(docs, model).where("kept").select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of fingerprints that links join: shingle length and bits of the operator's contract."""
    return simhash.one_of_each_group(docs, simhash.RADIUS, simhash.SHINGLE_WORDS).select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark")).select(docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their count and the digests of ids and decoded bytes."""
    ranks, pattern = byte_bpe()
    return token_digests(bpe.decode(bpe.encode(docs, ranks, pattern), ranks)).drop("decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", keep_good),
    ("SimHash near-dedup", drop_copies),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE", to_tokens),
]

#: Trained models and fingerprints are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
