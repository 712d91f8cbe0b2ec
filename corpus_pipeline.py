"""From raw documents to packed training sequences: STAGES in order, each over all that the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from martloom.llm import decontaminate, packing, quality, secret_scan, simhash
from martloom.llm.common import table
from martloom.llm.queries import TOKENIZER
from martloom.session import scratch_dir


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled ones among all documents."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id; groups as op10 has them."""
    return simhash.keep_first(docs, words=3, radius=2)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenized documents with their place in the training sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_near_copies),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

#: A fitted classifier, fingerprints and a tokenizer are not SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = f"{scratch_dir(spark)}/stage-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
