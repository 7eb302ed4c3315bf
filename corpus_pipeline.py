"""A training corpus from the documents table: rules, classifier, near-dedup, mixing, packing."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerbeam.llm import line_crf, mixing, near_copies, packing, quality_rules
from ledgerbeam.llm.common import shared_dir, table

#: The classifier and the packing have no SQL form; tests hold each stage against a plain version.
ORACLE_SQL = None


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality_rules.judge(docs.select(F.struct("*").alias("row"), "text"))
    return judged.where("kept").select("row.*")


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled rows of the documents table, calls good."""
    model = line_crf.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return line_crf.score(docs.select(F.struct("*").alias("row"), "text"), model).where("predicted = 1").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles with Jaccard similarity 0.8 or more."""
    return near_copies.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the mix's order, as often and as far as the mix takes them."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences; sequence_id and offset give their place."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", rules),
    ("quality_classifier", classifier),
    ("simhash_near_dedup", near_dedup),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; all but the last are written to the shared folder and read again."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.mode("overwrite").parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
    return docs
