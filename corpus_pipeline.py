"""The corpus pipeline: quality, near-duplicates, benchmark decontamination, mixing, token files.

Each stage takes the documents that the stage before kept, with all their columns; the last writes the token files and returns
their index. Stages hand their result on as Parquet in the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, mixing, neardup, quality, tokenfiles
from millrace.llm.components import Steps
from millrace.session import prepare, shared_dir
from millrace.tables import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts. It learns from the labelled ones among ``docs``."""
    labels = table(spark, sf_dir, "labels")
    return quality.accepted(docs, quality.fit(quality.labelled_sample(docs, labels), quality.label_counts(labels)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles agree to 0.8 or more, the one with the smallest id."""
    return neardup.one_of_each_group(docs, k=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty stands in a 13-word passage of the benchmark."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to the target weights takes them; a rate of 2 gives a document twice."""
    return mixing.mixed(docs, mixing.domain_of(table(spark, sf_dir, "labels")))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, and for each its id, start, number of tokens and checksum as read back."""
    folder = shared_dir(spark, "pipeline-tokens")
    written = tokenfiles.write_token_files(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, special=True)
    return tokenfiles.read_all(spark, folder, written)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_files", token_stage),
]

# The classifiers of the first and fourth stage and the tokenizer of the last cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(prepare(spark), sf_dir, "documents")
    steps = Steps(spark, "pipeline")
    for _, stage in STAGES:
        docs = steps.keep(stage(spark, docs, sf_dir))
    return docs
