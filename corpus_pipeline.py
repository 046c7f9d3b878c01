"""A training corpus from raw documents: five stages, each applying one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import decontam, packing, pii, simhash
from ledgerline.llm import toxicity as toxic
from ledgerline.llm.common import table, written
from ledgerline.llm.tokenfile import TOKENIZER, tokenizer_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; fitted on this stage's input."""
    return toxic.reject_toxic(docs, toxic.toxic_model(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the passages of the benchmark cut out of their texts."""
    return decontam.remove_passages(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind."""
    return pii.mask_personal_data(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 ids."""
    return packing.pack(docs, tokenizer_path(TOKENIZER))


STAGES = [
    ("toxicity", toxicity),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("pii", personal_data),
    ("best-fit packing", best_fit_packing),
]

# No stage but the packing of ids could be said in SQL, and that one only after the others.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``; what a stage returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
