"""The corpus pipeline: quality, repeated lines, near duplicates, mixture, tokens.

Each stage takes (spark, docs, folder of the tables) and works on all that the
stage before it kept; its result is written and read again for the next one.
``n_chars`` follows the text where a stage changes it. Columns besides doc_id and
text are carried along whatever their names, and an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import bpe, line_dedup, minhash, mixing, quality
from martloom.llm.common import stored, table

KEEP_FROM = 0.3  # quality score


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.

    Null and empty texts have the score of the model's bias; rows with one id or one
    text are scored each by itself and equally; a score of exactly ``KEEP_FROM`` stays.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, *model, column="__score").where(F.col("__score") >= KEEP_FROM).select(*docs.columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the long lines that a later document keeps.

    Null and empty texts stay as they are; rows with the largest id of a line all keep
    it, as they count as one document; rows with a null id keep no line that others have.
    """
    counts = ("__n_lines", "__n_dropped")
    kept = line_dedup.LineIndex.empty(spark).insert(docs).apply(docs, counts)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col(counts[1]) > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near duplicates (five words, similarity 0.8).

    Texts without words are alike with nothing and stay, null ones too; rows with one
    id are one document, so all of them stay or go; a similarity of exactly 0.8 is a link.
    """
    gone = minhash.near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("__gone"))
    gone = stored(gone.distinct(), "pipeline-gone")
    return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the rates that bring the domains as near their target weights as rates up to one can.

    Texts without words, null ones too, count in no total and are drawn by their own
    posterior; rows with one id are drawn together where their texts are equal; a rate
    of one always stays.
    """
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, hashes of the ids and of the text they decode to.

    Null text counts as empty and has no tokens; every row has its own row in the result.
    """
    return bpe.roundtrip_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_classifier),
    ("lines", line_deduplication),
    ("near_duplicates", near_deduplication),
    ("mixture", mixture),
    ("tokens", tokens),
]

ORACLE_SQL = None  # trained models have no SQL twin; tests/llm compares with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
