"""From raw documents to token files: five stages, each an operator of sublens.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs.  All but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sublens.llm import decontaminate, mixing, quality, records, simhash
from sublens.llm.common import discard, stored, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: that of the smallest id."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages to the limit go; others stay as they are."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Languages are brought to their target weights by repeating documents;
    none is lost."""
    labelled = docs.select("doc_id", "lang").join(
        table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return mixing.mix(docs, docs, labelled, least=1.0)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Record files and their index; returns a row for each record, as read back."""
    _, index = records.output(docs)
    return index.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality_filter", quality_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token_files", token_files),
]

# Learnt models, fingerprint groups and token files are not SQL's: the stages
# are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if name != STAGES[0][0]:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
