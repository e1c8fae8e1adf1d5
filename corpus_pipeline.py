"""A corpus made ready for training, stage by stage: each stage works on all that the one before it kept, written as Parquet and read again.

Nulls in any column are carried. Text null or without letters goes in the first stage, so later stages see letters only; a table
without rows stays one. Columns other than those of documents are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from areadep.llm import langid, minhash, mixing, packing, repeats
from areadep.llm.common import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SURE = 0.5      # least posterior of the predicted language of a document that stays


def row_name() -> Column:
    """The name by which operators return a row."""
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, and those whose language the model cannot tell, go."""
    model = langid.learn(docs)
    said = langid.predict(docs, model, COLUMNS)
    return said.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= SURE)).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays, and of equal rows one."""
    kept = minhash.near_duplicates(docs, Scratch(spark, "pipeline3")).where("kept").select("x").distinct()
    return docs.select(*COLUMNS).withColumn("x", row_name()).join(kept.hint("merge"), "x").dropDuplicates(["x"]).select(*COLUMNS)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that occur again anywhere are cut out; documents of which nothing is left go."""
    done = repeats.remove_repeats(docs, Scratch(spark, "pipeline2"), carry=["lang", "source"])
    left = done.where(F.trim("kept_text") != "")
    return left.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that the tokens of each domain come to their target share."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    copies = mixing.mix(docs, labels, Scratch(spark, "pipeline10")).where("copies > 0").select("x", "copies")
    chosen = docs.select(*COLUMNS).withColumn("x", row_name()).join(copies.hint("merge"), "x")
    return chosen.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.pack(packing.pieces(docs), Scratch(spark, "pipeline8"))


STAGES = [("language_id", language_id), ("minhash_near_dedup", near_dedup), ("suffix_array_dedup", repeat_removal),
          ("source_mixing", source_mixing), ("best_fit_packing", best_fit_packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
