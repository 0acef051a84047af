import os
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchboard.operators import analytics as A
from matchboard.sources import readers, results, writers
from matchboard.sources.keyindex import KeyIndex, bloom, bloom_holds

AT = "2026-05-17 12:00:00"


def test_watermark_bounds(spark, rows):
    df = spark.sql(
        "SELECT id, TIMESTAMP_NTZ'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS played_at FROM range(4)"
    )
    low, high = A.at("2020-01-01 00:00:01"), A.at("2020-01-01 00:00:03")
    assert rows(readers.incremental(df, "played_at", low, high), "id") == [(2,), (3,)]
    assert rows(readers.incremental(df, "played_at", low, high, closed=True), "id") == [(1,), (2,), (3,)]


def test_watermark_registry(spark, rows):
    empty = spark.createDataFrame([], "id long, point_of_time timestamp_ntz")
    assert rows(readers.watermark_state(empty, "2020-01-01 00:00:00")) == [(datetime(2020, 1, 1),)]
    loaded = spark.sql("SELECT TIMESTAMP_NTZ'2021-05-05 00:00:00' AS t")
    first = readers.watermark_advance(empty, loaded, "t")
    assert rows(first) == [(1, datetime(2021, 5, 5))]
    assert rows(readers.watermark_advance(first, loaded.limit(0), "t")) == rows(first)
    assert rows(readers.watermark_state(first, "2020-01-01 00:00:00")) == [(datetime(2021, 5, 5),)]


def test_filters_and_columns_reach_the_scan(tables):
    recent = A.elo_last_days(tables["elo_history"], "2001-08-01 00:00:00")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert "o_orderpriority" not in plan
    plan = A.win_rate(tables["matches"])._jdf.queryExecution().executedPlan().toString()
    assert "o_orderdate" not in plan and "partial_count" in plan


def test_append_is_stored_once(spark, tmp_path, rows):
    target = str(tmp_path / "t")
    batch = spark.createDataFrame([(1, "2020-01-01"), (2, "2020-01-02"), (2, "2020-01-02")], "id long, d string")
    batch = batch.select("id", F.col("d").cast("timestamp_ntz").alias("ts"))
    for _ in range(2):
        results.append_new(batch, target, "id", "ts")
    more = batch.unionByName(spark.sql("SELECT 3L AS id, TIMESTAMP_NTZ'2020-01-02 00:00:00' AS ts"))
    results.append_new(more, target, "id", "ts")
    assert rows(spark.read.parquet(target), "id") == [(1,), (2,), (3,)]


def test_results_expire(spark, tmp_path):
    store = results.ResultStore(spark, str(tmp_path))
    calls = []

    def build():
        calls.append(1)
        return spark.range(len(calls))

    assert store.cached_query("q", build, 3600, "2026-05-17 12:00:00").count() == 1
    assert store.cached_query("q", build, 3600, "2026-05-17 12:59:59").count() == 1
    assert store.cached_query("q", build, 3600, "2026-05-17 13:00:00").count() == 2
    assert store.cached_query("other", build, 3600, "2026-05-17 12:30:00").count() == 3
    empty = store.put("empty", spark.range(0), 3600, AT)
    assert empty.columns == ["id"] and store.valid("empty", AT).count() == 0


def test_export_of_odd_values(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [(1, 'say "hi", ok', None, 1.5), (2, "a\nb", "ż😀", None)], "id long, t string, u string, x double"
    ).withColumn("ts", F.lit("2026-05-17 11:49:20.035116").cast("timestamp_ntz"))
    path = writers.write(df, str(tmp_path / "json"), "json")
    stored = spark.read.schema(df.schema).option("timestampNTZFormat", readers.ISO).json(path)
    assert rows(stored) == rows(df)
    path = writers.write(df, str(tmp_path / "csv"), "csv")
    assert rows(readers.read_csv(spark, path, df.schema)) == rows(df)
    odd = ["", None, "\\N", "\\\\N", "N", "\\", '"', '""', "a,b", " padded ", "x\\", "\\,", "\r\n", "\n", '\\"', "'", "#"]
    texts = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate((a, b) for a in odd for b in odd)], "id long, a string, b string")
    path = writers.write(texts, str(tmp_path / "texts"), "csv")
    assert rows(readers.read_csv(spark, path, texts.schema)) == rows(texts)
    with pytest.raises(ValueError):
        writers.write(df, str(tmp_path / "x"), "xml")


def test_dated_layout(spark, tmp_path):
    base = str(tmp_path / "lake")
    for day in ("2026-05-07", "2026-05-08"):
        writers.write_dated(spark.range(3), base, day)
    assert sorted(os.listdir(f"{base}/year=2026/month=05")) == ["day=07", "day=08"]


def test_csv_schema_drift(spark, tmp_path, rows):
    old, new = T.StructType().add("id", "long"), T.StructType().add("id", "long").add("created_by", "string")
    writers.write(spark.range(1), str(tmp_path / "a"), "csv")
    writers.write(spark.sql("SELECT 7L AS id, 'x' AS created_by"), str(tmp_path / "b"), "csv")
    got = readers.read_csv_versions(spark, [(str(tmp_path / "a"), old), (str(tmp_path / "b"), new)])
    assert rows(got) == [(0, None), (7, "x")]


def test_json_records(spark, rows):
    df = spark.createDataFrame([('[{"id": 1}, {"id": 2}]',), ('{"id": 3}',)], "j string")
    assert rows(readers.from_json_records(df, "j", T.StructType().add("id", "long"))) == [(1,), (2,), (3,)]


def test_retention(spark, tmp_path):
    base = str(tmp_path / "lake")
    for day in ("2026-01-01", "2026-05-01"):
        writers.write_dated(spark.range(10).coalesce(2), base, day)
    old, new = (f"{base}/year=2026/month={m}/day=01" for m in ("01", "05"))
    then = datetime(2026, 1, 1).timestamp()
    for name in os.listdir(old):
        os.utime(f"{old}/{name}", (then, then))
    single = next(n for n in os.listdir(new) if n.endswith(".parquet"))
    os.utime(f"{new}/{single}", (then, then))
    before = datetime.fromtimestamp(os.stat(f"{new}").st_mtime)
    as_of = before.strftime("%Y-%m-%d %H:%M:%S")

    found = writers.retention(spark, base, as_of, 90)
    assert {(r["folder"][-12:], r["whole"]) for r in found.collect()} == {
        ("month=01/day=01"[-12:], True),
        ("month=05/day=01"[-12:], False),
    }
    assert os.path.exists(old)  # a dry run deletes nothing
    deleted = writers.retention(spark, base, as_of, 90, dry_run=False)
    assert deleted.count() == 2
    assert not os.path.exists(old)
    assert not os.path.exists(f"{new}/{single}") and os.listdir(new)
    assert writers.retention_report(readers.lake_files(spark, base), as_of).first()["n_files"] == 0


def test_snapshot_is_compressed_and_counted(spark, tmp_path, rows):
    manifest = writers.snapshot(spark, {"a": spark.range(3), "b": spark.range(0)}, str(tmp_path), AT)
    assert rows(manifest) == [("a", 3), ("b", 0)]
    assert any(n.endswith(".gz.parquet") for n in os.listdir(tmp_path / "backup_2026-05-17_12-00-00" / "a"))


def test_table_sizes(spark, tmp_path):
    for name in ("a", "b"):
        writers.write(spark.range(100), str(tmp_path / "base" / name))
    base = str(tmp_path / "base")
    got = readers.table_sizes(readers.lake_files(spark, base), base).collect()
    assert [r["table_name"] for r in got] == ["a", "b"] and all(r["size"].endswith("bytes") for r in got)


def test_scan_uses_the_declared_columns(spark, tmp_path):
    from matchboard.schema import TABLES

    path = str(tmp_path / "teams")
    spark.sql("SELECT 'a' AS id, 'x' AS name, true AS is_active, 1 AS extra").write.parquet(path)
    got = readers.scan(spark, path, "teams")
    assert got.schema == TABLES["teams"]  # missing columns are NULL, undeclared ones are not read
    assert got.first().asDict()["region"] is None and got.first()["name"] == "x"


@pytest.mark.parametrize("layout", sorted(name for name, (_, keys, _) in writers.LAYOUTS.items() if keys))
def test_bucketed_layouts_need_no_shuffle(spark, tables, tmp_path, layout, rows):
    stored = writers.store_layout(tables, layout, f"t_{layout}", str(tmp_path / layout), 4)
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        use = {
            "matches_by_tournament": A.frequent_pairs,
            "stats_by_match": A.avg_damage,
            "stats_by_player": A.last_n_per_player,
            "payouts_by_player": A.prize_by_player,
        }[layout]
        assert "Exchange" not in use(stored)._jdf.queryExecution().executedPlan().toString()
        assert rows(use(stored)) == rows(use(tables[writers.LAYOUTS[layout][0]]))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        spark.sql(f"DROP TABLE t_{layout}")


def test_a_table_with_a_hot_key_is_stored_in_even_ranges(spark, tmp_path, rows):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
    stored = writers.write_bucketed(df, "t_hot", str(tmp_path / "hot"), ("k",), ("k", "id"), 4, min_rows=100)
    try:
        sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 1000
        assert rows(stored) == rows(df)
    finally:
        spark.sql("DROP TABLE t_hot")


def test_csv_times_with_a_zone(spark, tmp_path):
    from matchboard.schema import TABLES

    path = tmp_path / "matches.csv"
    path.write_text(
        "id,tournament_id,team_a_id,team_b_id,winner_id,played_at\n"
        "m1,t1,a,b,a,2026-05-17 11:49:20.035116+00:00\nm2,t1,b,a,a,2026-05-17 11:49:20+00:00\n"
    )
    older = T.StructType(TABLES["matches"].fields[:-1])
    got = readers.read_csv_versions(spark, [(str(path), older)]).orderBy("id").collect()
    assert [r["played_at"].isoformat() for r in got] == ["2026-05-17T11:49:20.035116", "2026-05-17T11:49:20"]


def test_ratings_are_stored_by_time(spark, tables, tmp_path, rows):
    stored = writers.store_layout(tables, "ratings_by_time", "t_ratings", str(tmp_path / "ratings"), 4)
    try:
        span = stored.groupBy(F.input_file_name()).agg(F.min("changed_at").alias("lo"), F.max("changed_at").alias("hi"))
        files = span.orderBy("lo").collect()
        assert len(files) == 4 and all(a["hi"] <= b["lo"] for a, b in zip(files, files[1:]))
        assert rows(A.elo_last_days(stored, "2000-01-01")) == rows(A.elo_last_days(tables["elo_history"], "2000-01-01"))
    finally:
        spark.sql("DROP TABLE t_ratings")


def test_rows_without_a_time_are_stored_once(spark, tmp_path, rows):
    batch = spark.sql("SELECT 1L AS id, CAST(null AS timestamp_ntz) AS ts UNION ALL SELECT 2L, TIMESTAMP_NTZ'2020-01-01'")
    for _ in range(2):
        results.append_new(batch, str(tmp_path / "t"), "id", "ts")
    assert rows(spark.read.parquet(str(tmp_path / "t")), "id") == [(1,), (2,)]


def test_second_delivery_reads_few_files(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "target")
    rows = spark.range(4000).select(F.concat(F.lit("k"), F.xxhash64("id").cast("string")).alias("id"), F.timestamp_seconds("id").alias("ts"), "id")
    rows = rows.toDF("id", "ts", "n")
    asked = []
    own = KeyIndex.files_with
    monkeypatch.setattr(KeyIndex, "files_with", lambda self, keys: asked.append(own(self, keys)) or asked[-1])
    for low in range(0, 4000, 200):
        assert results.append_new(rows.where((F.col("n") >= low) & (F.col("n") < low + 200)).coalesce(1), target, "id", "ts") == 200
    files = len(list((tmp_path / "target").glob("*.parquet")))
    assert files >= 20 and asked[0] == []
    again = rows.where("n >= 600 AND n < 650").union(rows.where("n = 3999"))
    assert results.append_new(again.coalesce(1), target, "id", "ts") == 0
    assert 2 <= len(asked[-1]) <= 4 < files  # the files that hold them, and hardly one in vain
    mixed = again.select("id", "ts", "n").union(spark.sql("SELECT 'new' AS id, TIMESTAMP'2024-01-01' AS ts, -1L AS n"))
    assert results.append_new(mixed, target, "id", "ts") == 1 and results.append_new(mixed, target, "id", "ts") == 0
    assert spark.read.parquet(target).count() == 4001
    assert spark.read.parquet(target).select("id").distinct().count() == 4001


def test_index_that_lags_or_errs_changes_nothing(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "target")
    rows = spark.range(100).select("id", F.timestamp_seconds("id").alias("ts"))
    rows.where("id < 50").repartition(2).write.parquet(target)  # without an index
    assert len(KeyIndex(spark, target, "id").files_with(rows)) == 2
    assert results.append_new(rows.where("id < 60"), target, "id", "ts") == 10
    assert KeyIndex(spark, target, "id").refresh() == 0
    next((tmp_path / "target").glob("*.parquet")).unlink()  # dropped by hand: its rows are new again
    lost = 60 - spark.read.parquet(target).count()
    monkeypatch.setattr("matchboard.sources.keyindex.BITS_PER_KEY", 1)  # nearly every answer is in vain
    assert lost > 0 and results.append_new(rows, target, "id", "ts") == 40 + lost
    assert sorted(r.id for r in spark.read.parquet(target).select("id").collect()) == list(range(100))
    monkeypatch.setattr("matchboard.sources.keyindex.FEW_KEYS", 10)  # more keys: their range alone
    assert results.append_new(rows.union(spark.sql("SELECT 100L, TIMESTAMP'2024-01-01'")), target, "id", "ts") == 1
    assert KeyIndex(spark, target, "id").files_with(spark.range(500, 600)) == []


def test_filters_of_a_file_are_of_bounded_size(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "target")
    keys = spark.range(5000).select(F.when(F.col("id") % 50 > 0, F.col("id")).alias("id"))
    keys.repartition(2).write.parquet(target)
    spark.range(0).write.mode("append").parquet(target)
    files = len(list((tmp_path / "target").glob("*.parquet")))
    monkeypatch.setattr("matchboard.sources.keyindex.KEYS_PER_FILTER", 512)
    index = KeyIndex(spark, target, "id")
    assert index.refresh() == files and index.refresh() == 0
    entries = spark.read.parquet(f"{target}/_keys")
    assert entries.agg(F.max(F.length("bloom"))).first()[0] <= 2048  # 512 keys of 24 bits, rounded up
    assert entries.select("file").distinct().count() == files and entries.count() >= 5000 / 512
    held = {f: set(r.id for r in spark.read.parquet(f).collect()) for f in index.files_with(keys)}
    for key in (1, 777, 2499, 4999):
        assert {f for f, ids in held.items() if key in ids} <= set(index.files_with(spark.createDataFrame([(key,)], "id long")))


def test_bloom_filter():
    hashes = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, size=5000)
    held = bloom(hashes[:2000])
    assert bloom_holds(held, hashes[:2000]).all() and bloom_holds(held, hashes[2000:]).sum() <= 3
    assert not bloom_holds(bloom(hashes[:0]), hashes).any()
