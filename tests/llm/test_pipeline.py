"""The pipeline and the registered queries on the smallest tables."""

import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check
import corpus_pipeline
from matchboard.llm import decontaminate, secret_scan, simhash
from matchboard.llm.common import read_table, stored
from matchboard.llm.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, name):
    duck = duckdb.connect()
    for table in check.TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{DATA}/{table}.parquet')")
    got, expected = QUERIES[name](spark, DATA).toArrow(), duck.execute(ORACLE[name]).to_arrow_table()
    assert check.shape(got) == check.shape(expected) and check.rows(got) == check.rows(expected)


@pytest.mark.parametrize("name", ["op1", "op3", "op5", "op6", "op7", "op9", "op10", "op11"])
def test_query_returns_every_row(spark, name):
    query = next(f for n, f in QUERIES.items() if n.startswith(name + "_"))
    table, key = ("pages", "page_id") if name == "op3" else ("documents", "doc_id")
    got = query(spark, DATA).select(key).collect()
    assert sorted(r[0] for r in got) == sorted(r[0] for r in read_table(spark, DATA, table).select(key).collect())


def test_toxicity_on_held_out_rows(spark):
    got = QUERIES["op10_toxicity_lexicon"](spark, "/root/testdata/sf0.01").join(read_table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) >= 0.9 * len(held)


def test_stages(spark):
    docs = read_table(spark, DATA, "documents")
    extra = docs.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit("no id").alias("text"), "lang", "source", "n_chars")
    docs = stored(docs.union(docs.where("doc_id < 5")).union(extra), "test")
    toxic_free = corpus_pipeline.without_toxic(spark, docs, DATA)
    assert toxic_free.columns == docs.columns
    classes = simhash.near_duplicates(docs)
    single = corpus_pipeline.one_of_each(spark, docs, DATA)
    expected = {r[0] for r in classes.select("component_id").where("component_id IS NOT NULL").distinct().collect()} | {None}
    ids = [r[0] for r in single.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and set(ids) == expected and single.columns == docs.columns
    leaks = {r[0] for r in decontaminate.find_items(docs, read_table(spark, DATA, "benchmark")).select("doc_id").collect()}
    kept = corpus_pipeline.without_benchmark(spark, docs, DATA)
    assert leaks and sorted(r[0] or -1 for r in kept.select("doc_id").collect()) == sorted(r[0] or -1 for r in docs.select("doc_id").collect() if r[0] not in leaks)
    clean = stored(corpus_pipeline.without_secrets(spark, docs, DATA), "test")
    assert clean.dtypes == docs.dtypes and clean.count() == docs.count()
    assert secret_scan.report(clean).where("n_assign + n_access + n_hex > 0").count() == 0
    assert clean.where(F.col("n_chars") != F.length("text")).count() == 0
    assert corpus_pipeline.to_tokens(spark, docs, DATA).count() == docs.count()


def test_rows_are_judged_whatever_their_ids(spark):
    item = read_table(spark, DATA, "benchmark").where(F.length("text") > 100).head().text
    near, other = " ".join(f"word{i}" for i in range(400)), " ".join(f"term{i}" for i in range(300))
    texts = [(None, item), (None, near), (None, near), (None, near.upper()), (None, other), (7, "lone words here"), (7, other + " and more of it here"), (7, item), (8, near[::-1])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], read_table(spark, DATA, "documents").schema)
    free = corpus_pipeline.without_benchmark(spark, docs, DATA).select("doc_id", "text").collect()
    assert sorted(map(tuple, free), key=repr) == sorted((x for x in texts if x[1] != item), key=repr)
    for given in (docs, stored(docs, "test")):
        one = corpus_pipeline.one_of_each(spark, given, DATA)
        groups = {simhash.fingerprint(t, 3) for _, t in texts}
        assert one.columns == docs.columns and one.count() == len(groups) == len({simhash.fingerprint(r.text, 3) for r in one.collect()})
        assert sorted((r.doc_id or -1 for r in one.collect() if r.text in (item, "lone words here")), reverse=True) == [7, 7]


def test_run(spark):
    assert 0 < corpus_pipeline.run(spark, DATA).count() < read_table(spark, DATA, "documents").count()
