"""The registered queries of the corpus operators, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    chunks, langid, lmscore, minhash, mixing, neardup_vectors, packing, pagetext, periodic, permutation_index, repeats, secretscan, spelling,
)
from .common import Scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup_vectors.near_duplicates(table(spark, sf_dir, "embeddings"), Scratch(spark, "op1"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), Scratch(spark, "op2"), texts=False)


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark, "op3")).drop("x")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.dedup(table(spark, sf_dir, "documents"), Scratch(spark, "op4"), run=1, texts=False)      # every repeated chunk counts


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", langid.held_out().alias("held_out"))
    model = langid.learn(docs.where("not held_out"))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model, ["doc_id", "held_out"])


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score(table(spark, sf_dir, "documents"), Scratch(spark, "op6"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return permutation_index.nearest(vectors, vectors.where("vec_id % 50 = 0"), Scratch(spark, "op7"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op8")
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")), scratch)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.extract(table(spark, sf_dir, "pages"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Scratch(spark, "op10")).drop("x")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(table(spark, sf_dir, "documents"), one_in=97)
    return spelling.variants(words, Scratch(spark, "op11"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.digest(secretscan.scan(table(spark, sf_dir, "documents"), ["doc_id"]), ["doc_id"])


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.made_periodic(table(spark, sf_dir, "documents"))
    return periodic.digest(periodic.find_runs(docs, ["doc_id"]), ["doc_id"])


QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_language_id": op5_language_id,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_html_extraction": op9_html_extraction,
    "op10_source_mixing": op10_source_mixing,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_secret_scan": op12_secret_scan,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLE: dict[str, str] = {"op11_spelling_variants": spelling.SQL}
