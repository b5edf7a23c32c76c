"""Corpus pipeline: quality rules, near duplicates, secrets, mixing and packing over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns
a DataFrame; all but the last return the columns of ``documents``. Between
stages the rows are written as Parquet under the shared checkpoint folder and
read again, so a lost executor costs at most one stage.

Defined results: null or blank texts fail the quality rules; of near duplicates
the row with the smallest (doc_id, reading order) stays; secrets are replaced by
a mark and ``n_chars`` follows; mixing samples by the default temperatures;
columns beyond those of ``documents`` are dropped; empty tables give no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import mixing, ngram_join, packing, quality, secrets
from quarry.llm.util import pinned, sent_if_small
from quarry.session import ensure_checkpoint_dir
from quarry.sources.tables import load

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the plain rules and the line labels keep."""
    docs = docs.select(*COLUMNS)
    field = quality.learned_field(docs, load(spark, sf_dir, "labels"))
    return quality.apply_rules(docs, field).filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates."""
    # written with their numbers: a second reading may be cut into other tasks, and so be numbered otherwise
    folder = f"{ensure_checkpoint_dir(spark)}/numbered-{uuid.uuid4().hex}"
    docs.select(*COLUMNS).withColumn("_q_row", F.monotonically_increasing_id()).write.parquet(folder)
    numbered = spark.read.parquet(folder)
    others = pinned(ngram_join.near_duplicates(numbered, row="_q_row").filter("not keeper").select(F.col("row").alias("_q_row")))
    return numbered.join(sent_if_small(others), "_q_row", "left_anti").select(*COLUMNS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced."""
    clean = secrets.redact(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights of sources, languages and topics."""
    return mixing.mix(mixing.measured(docs.select(*COLUMNS))).filter("sampled").select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in a sequence."""
    return packing.packed_documents(docs.select(*COLUMNS))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", mixing_to_targets),
    ("best-fit packing", best_fit_packing),
]

# A conditional random field, a token join and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = load(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
