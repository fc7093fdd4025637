"""A corpus pipeline: each stage calls one operator of ``tidemill.llm`` on all
that the stage before it kept. ``run`` writes each stage's rows as Parquet in
the shared folder and reads them as the next stage's documents.

Stages keep all columns of ``documents`` but the last, which returns what
encoding returns. Null ids, null and empty texts, ties and empty tables are
treated as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import bpe, mixing, quality, simhash, toxicity
from tidemill.llm.common import written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score 0.5 or more)."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(quality.scorer(spark, model)("text") >= 0.5)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(toxicity.scorer(spark, model)("text") < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.keep_one(spark, docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.apply(spark, docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each document."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(spark, docs, path, public_tokenizers.PATTERN, digests=True)


STAGES = [
    ("quality classifier", keep_quality),
    ("toxicity", drop_toxic),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing", mix),
    ("byte-level BPE", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs


#: Trained classifiers, fingerprints and merges have no SQL; tests hold run()
#: against a brute-force version.
ORACLE_SQL = None
