"""A corpus through five stages: language, near-duplicates, benchmark passages, secrets, tokens.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import decontam, langid, neardup, pieces, secretscan
from spanloom.llm.registry import model_path
from spanloom.llm.shared import without_ids, write_table
from spanloom.session import ship_package


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that language identification rejects; the model learns from the labelled ones."""
    ship_package(spark)
    return langid.identify(docs, langid.train(docs)).where("not rejected").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group linked by five-word shingles at 0.8 or more."""
    ship_package(spark)
    return neardup.drop_near_duplicates(docs, shingle=5, percent=80).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten consecutive words of a benchmark item, or all words of a shorter one."""
    ship_package(spark)
    found = decontam.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=10)
    return without_ids(docs, "doc_id", found.where("contaminated")).select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark; every document stays, and n_chars follows its text."""
    ship_package(spark)
    found = secretscan.redact(docs, secretscan.train(docs))
    return found.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of each text, their number, and whether decoding gave the text back."""
    ship_package(spark)
    found = pieces.encode(docs.select("doc_id", "text"), model_path())
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("language ID", language),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: Trained models and the piece encoder can't be written in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
