"""The training-data pipeline: stages over ``documents``, in order.

Each stage gets the rows that the one before kept and returns the columns of documents;
the last returns the piece ids. A document that the mix draws several times is so many
rows from there on.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from dailyfacts.llm import partenum, piece_codec, quality_fm, rule_ledger, source_mix
from dailyfacts.llm.common import kept

#: Folder of the public tokenizers' files, on every machine.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
#: Distinct words that a worker remembers the ids of, and bytes of text that it encodes in one go.
REMEMBERED = 100_000
SLICE = 1 << 18


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the production policy go."""
    return rule_ledger.keep_passing(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that more likely have label 0 go.

    The machine is fitted on labelled documents of the whole table: what the rules have
    left holds hardly any of label 0.
    """
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = quality_fm.fit(whole, labels, metadata=["n_chars"])
    return quality_fm.keep_good(docs, machine)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return partenum.one_of_each_group(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the production weights; rows in the order of the output shards."""
    return source_mix.mixed_documents(docs)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_ids, round_trip`` of every row.

    Executors still hold what the stages before took, so that workers take less here than by themselves.
    """
    return piece_codec.encode(
        docs, f"{TOKENIZERS}/piece_bpe_32k.model", remembered=REMEMBERED, slice_bytes=SLICE
    )


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources", source_mixing),
    ("SentencePiece", piece_encoding),
]

#: The classifier and the hashed mix have no SQL; a test compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = kept(stage(spark, docs, sf_dir), f"stage-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
