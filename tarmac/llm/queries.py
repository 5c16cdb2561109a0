"""The queries of the thirteen operators over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import bpe, entropy, licenses, lines, mixing, ngram_join, oracle, pii, pivots, prefixes, spots, suffixes, toxicity, variants
from tarmac.llm.book import ORACLES, QUERIES, query
from tarmac.llm.tables import read

__all__ = ["ORACLES", "QUERIES", "tokenizer_path"]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query()
def op1_spot_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.with_next(read(spark, sf_dir, "documents"))


@query(oracle.NGRAM_JOIN)
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"), ngram_join.Rule(width=4, percent=85))


@query()
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(read(spark, sf_dir, "documents"), "doc_id")


@query()
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), tokenizer_path(), "doc_id")


@query(oracle.MIXING)
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(read(spark, sf_dir, "documents"))


@query()
def op6_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    background, target = entropy.counts(docs, read(spark, sf_dir, "labels"), toxicity.held_out)
    scored = entropy.score(docs.select("doc_id", "text"), background, target)
    return scored.drop("text").withColumn("held_out", toxicity.held_out(F.col("doc_id")))


@query()
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read(spark, sf_dir, "documents"), "doc_id")


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query(oracle.NEAR_VECTORS)
def op9_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_vectors(read(spark, sf_dir, "embeddings"))


@query(oracle.LINE_DEDUP)
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


@query(oracle.SUFFIX_DEDUP)
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffixes.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(oracle.SPELLING_VARIANTS)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query(oracle.PREFIX_TRIE)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(read(spark, sf_dir, "conversations"))
