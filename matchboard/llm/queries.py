"""One registered query per operator, over its whole table, and the SQL that some of them are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchboard.llm import (
    decontaminate,
    html_text,
    knn,
    line_runs,
    secret_scan,
    sentencepiece_dropout,
    sharding,
    simhash,
    spelling,
    token_files,
    toxicity,
    warc,
    whitening,
)
from matchboard.llm.common import read_table

QUERIES = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op6_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes; equal texts stay together."""
    placed = sharding.assign(read_table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the smallest document it is linked to."""
    classes = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_distance=3)
    return classes.select("doc_id", simhash.hex_print("fp").alias("fingerprint"), "component_id")


@query
def op8_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth vector, among all others."""
    return knn.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_scan.report(read_table(spark, sf_dir, "documents"))


@query
def op10_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from the labels that are not held out."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~toxicity.held_out()))
    rows = toxicity.scored(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op2_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds, with the words in which it differs."""
    return decontaminate.find_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op1_sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with merge-dropout and decoded again."""
    return sentencepiece_dropout.round_trips(read_table(spark, sf_dir, "documents"), dropout=0.1, seed=17)


@query
def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(read_table(spark, sf_dir, "pages"))


@query
def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back by way of the capture index."""
    found = warc.archive(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op5_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids, written to grammar-compressed files and read back."""
    return token_files.read_shards(token_files.write_shards(read_table(spark, sf_dir, "documents"), added_tokens=True))


@query
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that at least five documents hold, the last of them excepted."""
    kept = line_runs.deduplicate(read_table(spark, sf_dir, "documents"), min_docs=5, min_chars=40)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with the far more frequent word one edit away, if there is one."""
    return spelling.variants(spelling.vocabulary(read_table(spark, sf_dir, "documents"), min_chars=7, min_count=2))


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitened coordinates of every vector along the first eight components of all vectors."""
    rows = whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=8)
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


_DIGITS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> {shift}) & 31) + 1, 1)" for shift in (15, 10, 5, 0))

# base 32 by groups of five hexadecimal digits, which are four digits there
ORACLE["op4_warc_index"] = f"""
WITH page AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages),
copies AS (SELECT digest, max(page_id) AS chosen FROM page GROUP BY digest)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string([{_DIGITS} FOR v IN [('0x' || substr(digest, 5 * i + 1, 5))::BIGINT FOR i IN range(8)]], '') AS payload_digest,
  CASE WHEN page_id = chosen THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> chosen THEN chosen END AS refers_to
FROM page JOIN copies USING (digest)
"""

_WHITE = " || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))

ORACLE["op11_line_dedup"] = f"""
WITH doc AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM doc),
keyed AS (SELECT *, translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line),
frequent AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT doc_id, line, place, coalesce(doc_id <> keeper, false) AS gone FROM keyed LEFT JOIN frequent USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
