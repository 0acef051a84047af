"""Cases that once gave wrong rows or lost data."""

import os
import time

import pytest
from pyspark.sql import types as T

from matchboard import cluster
from matchboard.operators import analytics, network
from matchboard.sources import readers, results, writers


def test_retention_keeps_live_files_below_an_expired_one(spark, tmp_path):
    old, new = tmp_path / "a" / "old.csv", tmp_path / "a" / "sub" / "new.csv"
    gone = tmp_path / "b" / "old.csv"
    for file in (old, new, gone):
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("x")
    now = time.time()
    for file in (old, gone):
        os.utime(file, (now - 400 * 86400,) * 2)
    writers.retention(spark, str(tmp_path), time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime(now)), 90, dry_run=False)
    assert new.exists() and not old.exists() and not gone.exists() and not (tmp_path / "b").exists()


def test_an_id_with_another_time_is_stored_once(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "id long, at timestamp_ntz"
    rows = lambda *pairs: spark.sql("SELECT * FROM VALUES " + ", ".join(f"({i}L, TIMESTAMP_NTZ'{t}')" for i, t in pairs) + " AS t(id, at)")
    results.append_new(rows((1, "2024-01-01 00:00:00")), path, "id", "at")
    results.append_new(rows((1, "2024-03-01 00:00:00"), (2, "2024-03-01 00:00:00")), path, "id", "at")
    assert sorted(r.id for r in spark.read.schema(schema).parquet(path).collect()) == [1, 2]


def test_counters_count_a_match_once_per_team(spark, rows):
    matches = spark.createDataFrame([(1, 1, 1), (1, 2, None), (None, 1, 1)], "team_a_id long, team_b_id long, winner_id long")
    assert rows(analytics.team_counters(matches)) == [(1, 3, 2), (2, 1, 0)]


def test_reach_has_no_end(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(12)], "src long, dst long")
    assert network.team_reach(chain).count() == 78
    assert network.team_reach(chain, 8).count() == 68


def test_a_second_run_of_a_date_replaces_the_first(spark, tmp_path):
    for day in ("2024-05-01", "2024-05-01", "2024-05-02"):
        writers.write_dated(spark.range(5), str(tmp_path / "d"), day)
    assert spark.read.parquet(str(tmp_path / "d")).count() == 10


def test_csv_keeps_text(spark, tmp_path):
    texts = ["two\nlines", " pad ", 'a "quote", and comma', "plain"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    writers.write(frame, str(tmp_path / "c"), "csv")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])
    got = readers.read_csv_versions(spark, [(str(tmp_path / "c"), schema)])
    assert [r.text for r in got.orderBy("id").collect()] == texts


def test_a_cluster_needs_a_shared_folder():
    class Context:
        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return "yarn" if key == "spark.master" else default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        cluster.shared_root(Session())


def test_retention_may_be_run_again(spark, tmp_path):
    """A delete task that is run a second time finds its files gone and reports the same."""
    import pyarrow as pa

    files = [tmp_path / f"a b%20{i}" / "x=1" / "old file.csv" for i in range(3)]
    for file in files:
        file.parent.mkdir(parents=True)
        file.write_text("x")
    listing = readers.lake_files(spark, str(tmp_path)).collect()
    batch = pa.RecordBatch.from_arrays([pa.array([r.path for r in listing]), pa.array(["f"] * 3), pa.array([1, 1, 1])], ["path", "folder", "length"])
    first, second = (next(writers._delete_files(iter([batch]))) for _ in range(2))
    assert first.equals(second) and not any(f.exists() for f in files)
    folders = pa.RecordBatch.from_arrays([pa.array([r.path.rsplit("/", 1)[0] for r in listing])], ["folder"])
    first, second = (next(writers._delete_empty_folders(iter([folders]))) for _ in range(2))
    assert first.equals(second) and first.num_rows == 3 and not any(f.parent.exists() for f in files)
