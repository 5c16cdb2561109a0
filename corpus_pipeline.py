"""The corpus pipeline: documents in, encoded training mix out.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and
returns a DataFrame, which is written to the shared folder and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import bpe, lines, mixing, ngram_join, toxicity
from tarmac.llm.queries import tokenizer_path
from tarmac.llm.tables import read, settle


def _row(docs: DataFrame) -> Column:
    """The caller's columns, whatever their names, out of the operators' way."""
    return F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"_row.`{c}`").alias(c) for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold stay, with their own columns. Null and empty texts score like empty ones."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select(_row(docs), "text"), model)
    return scored.filter(F.col("score") < toxicity.THRESHOLD).select(*_columns(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines of repeated windows; a document of which nothing is left goes. Other columns stay."""
    left = lines.dedup_lines(docs.select(_row(docs), "doc_id", "text"))
    emptied = (F.col("n_removed") > 0) & (F.trim("text") == "")
    own = {"text": F.col("text"), "n_chars": F.when(
        F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("_row.n_chars"))}
    return left.filter(~F.coalesce(emptied, F.lit(False))).select(
        *[own.get(name, column).alias(name) for name, column in zip(docs.columns, _columns(docs))])


def _keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """The rows with a key each (``_key``), and whether there are rows whose ``doc_id`` is no key.

    That is ``doc_id`` where one row has it. Rows without or with a shared one get a hash of their id and text, which
    only equal rows share, above all usual ids.
    """
    shared = settle(docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null").select(
        F.col("doc_id").alias("_shared")), "shared-ids")
    rows = docs.select(_row(docs), "doc_id", "text")
    if shared.isEmpty():
        return rows.withColumn("_key", F.col("doc_id")), False
    own = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2).bitwiseOR(F.lit(1 << 62))
    marked = rows.join(shared.withColumn("_odd", F.lit(True)), F.col("doc_id").eqNullSafe(F.col("_shared")), "left")
    return marked.withColumn("_key", F.when(F.col("_odd"), own).otherwise(F.col("doc_id"))), True


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies (five words, 0.8) one document stays, that of the smallest ``doc_id``.

    Rows without words are in no class and stay. Of rows that share a ``doc_id`` or have none, each counts for itself by
    its text, after those with an id of their own; of equal rows one stays.
    """
    rows, odd = _keyed(docs)
    classes = ngram_join.near_duplicates(
        rows.select(F.col("_key").alias("doc_id"), "text"), ngram_join.Rule(width=5, percent=80)).filter("n_shingles > 0")
    gone = settle(classes.filter(F.col("doc_id") != F.col("component_id")).select(
        F.col("doc_id").alias("_gone")).distinct(), "near-copies")
    left = rows.join(gone, F.col("_key") == F.col("_gone"), "left_anti")
    if odd:  # equal rows have one key; null texts too, which have no copies
        worded = classes.select(F.col("doc_id").alias("_worded")).distinct()
        marked = left.join(worded, F.col("_key") == F.col("_worded"), "left").withColumn(
            "_one", F.when(F.col("_odd") & F.col("_worded").isNotNull(), F.col("_key")))
        many = marked.filter("_one is not null").groupBy("_one").agg(F.first("_row").alias("_row"))
        left = marked.filter("_one is null").select("_row").union(many.select("_row"))
    return left.select(*_columns(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, as rows."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row of the mix its number of tokens and the digests of its tokens and decoded text."""
    return bpe.digests(docs, tokenizer_path(), "doc_id", "source")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram join", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

ORACLE_SQL = None  # compression and the hashed order of the mix have no SQL form; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; the last one is returned without being written."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
