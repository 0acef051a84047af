"""From raw documents to token ids: five stages, each on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next one's documents. All stages but the last return the columns of documents. Every row is judged by its own
text, whether its id is null or repeated; of rows that are near copies the second stage keeps one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchboard.llm import decontaminate, secret_scan, sentencepiece_dropout, simhash, toxicity
from matchboard.llm.common import read_table, stored

TOXIC_FROM = 0.3


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; it learns from the labels that are not held out."""
    labels = read_table(spark, sf_dir, "labels").where(~toxicity.held_out())
    model = toxicity.train(docs, labels)
    return toxicity.scored(docs, model, "__score").where(F.col("__score") < TOXIC_FROM).select(*_columns(docs))


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows and the place where each is stored (__file, __row), which tells them apart whatever their ids are.

    A hash stands for the file: paths would take hundreds of megabytes where the kept rows are broadcast.
    """

    def placed(rows: DataFrame) -> DataFrame:
        at = rows.metadataColumn("_metadata")
        return rows.select(*_columns(docs), F.xxhash64(at["file_path"]).alias("__file"), at["row_index"].alias("__row"))

    try:
        return placed(docs)
    except AnalysisException:  # not rows of files
        return placed(stored(docs, "rows"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near copies: one with the smallest id, or without an id where no row has one."""
    numbered, place = _numbered(docs), ("__file", "__row")
    kept = stored(simhash.representatives(numbered, place, shingle=3, max_distance=3), "simhash-kept")
    # shuffled at every size: a row for every text is no small table
    return numbered.join(kept.hint("merge"), list(place), "left_semi").select(*_columns(docs))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark item."""
    return decontaminate.without_items(docs, read_table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in their texts are replaced."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, cut with merge-dropout."""
    encoded = sentencepiece_dropout.encoded(docs.select("doc_id", "text"), dropout=0.1, seed=17)
    return encoded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", one_of_each),
    ("benchmark_decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("sentencepiece", to_tokens),
]

# Fingerprints, a fitted model and an agenda have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of the folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
