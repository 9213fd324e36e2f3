"""A training corpus from ``documents``: quality, near duplicates, benchmark leaks, source mix, token files.

Every stage reads what the one before it has written. Rows keep all columns of documents, also extra ones; ids decide
rows, and rows without an id pass the filters (they can't be named by a decision). An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.llm import decontaminate, mixing, near_dup, quality, tokens
from tillwise.llm.common import new_path
from tillwise.llm.registry import tokenizer_path


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is not among ``ids`` (one column, ``__gone``)."""
    return docs.join(ids.distinct(), docs["doc_id"] == F.col("__gone"), "left_anti")


def quality_kept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    scores = quality.score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _without(docs, scores.where("predicted = 0").select(F.col("doc_id").alias("__gone")))


def near_duplicates_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class the document with the least id."""
    found = near_dup.classes(docs)
    return _without(docs, found.where("doc_id <> class_id").select(F.col("doc_id").alias("__gone")))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    leaks = decontaminate.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, leaks.select(F.col("doc_id").alias("__gone")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources and shuffled; a document drawn n times is n equal rows."""
    return mixing.mix(docs, keep=tuple(docs.columns)).select("kept.*")


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token files, and their index read back from them."""
    return tokens.write_and_index(docs, tokenizer_path(), new_path(spark, "corpus-tokens"))


STAGES = [("quality", quality_kept), ("near_duplicates", near_duplicates_removed), ("decontamination", decontaminated), ("mixing", mixed),
          ("tokens", token_files)]
ORACLE_SQL = None  # the classifier and the tokenizer have no SQL form; tests compare the stages with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
