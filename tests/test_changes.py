import json
import math
import random

import pytest

from pyspark.sql import functions as F

from matchboard.operators import changes as C
from matchboard.operators import network as N

LOG = "id long, version long, operation string, elo_rating int, changed_at string"


def test_audit_rows(spark):
    before = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3)], "id long, name string, elo int")
    after = spark.createDataFrame([(1, "a", 1), (2, "b", 5), (4, "d", None)], "id long, name string, elo int")
    got = C.audit_diff(before, after, "id", "players", "2026-05-17 00:00:00").orderBy("row_key").collect()
    assert [(r["row_key"], r["operation"]) for r in got] == [(2, "UPDATE"), (3, "DELETE"), (4, "INSERT")]
    assert json.loads(got[0]["old_data"]) == {"id": 2, "name": "b", "elo": None}
    assert json.loads(got[0]["new_data"])["elo"] == 5
    assert got[1]["new_data"] is None and got[2]["old_data"] is None


def test_updates_newest_wins_and_unknown_is_reported(spark, rows):
    df = spark.createDataFrame([(1, 10), (2, 20)], "id long, elo_rating int")
    changes = [(1, 1, 11), (1, 2, 12), (2, 1, None), (9, 1, 5)]
    updates = spark.createDataFrame(changes, "id long, v long, elo_rating int")
    updated, unmatched = C.apply_updates(df, updates, "id", ["elo_rating"], "v")
    assert rows(updated) == [(1, 12), (2, None)]
    assert rows(unmatched) == [(9, 5)]
    assert updated.columns == df.columns


def test_backfill_fills_only_what_is_missing(spark, rows):
    df = spark.createDataFrame([(1, "me"), (2, None)], "id long, created_by string")
    got = dict(C.backfill(df, "created_by", ["x", "y"], "id").collect())
    assert got[1] == "me" and got[2] in ("x", "y")
    assert C.backfill(df.select("id"), "created_by", ["x"], "id").columns == ["id", "created_by"]


def test_bloat_and_compaction(spark, rows):
    log = spark.createDataFrame(
        [(1, 1, "INSERT", 5, "t"), (1, 2, "UPDATE", 6, "t"), (2, 3, "INSERT", 7, "t"), (3, 4, "DELETE", 8, "t")], LOG
    )
    assert rows(C.changelog_compact(log, "id", "version"), "id", "elo_rating") == [(1, 6), (2, 7)]
    named = log.withColumn("table_name", F.lit("players"))
    assert rows(C.changelog_bloat(named, "id", "version")) == [("players", 2, 2, 50.0)]
    tidy = named.filter("version > 1 AND id < 3")
    assert C.changelog_bloat(tidy, "id", "version").count() == 0


def test_traversals_of_a_cycle(spark, rows):
    played = [("A", "B"), ("B", "C"), ("C", "A"), ("A", "B")]
    matches = spark.createDataFrame(played, "team_a_id string, team_b_id string")
    network = N.team_network(matches)
    assert rows(network, "full_path", "level", "n_rows") == [
        ("A->B", 1, 1), ("A->B->C", 2, 1), ("B->C", 1, 1), ("B->C->A", 2, 1), ("C->A", 1, 1), ("C->A->B", 2, 2),
    ]
    edges = N.team_edges(matches)
    assert rows(N.team_paths(edges, 8), "full_path") == [
        ("A->B",), ("A->B->C",), ("B->C",), ("B->C->A",), ("C->A",), ("C->A->B",),
    ]
    assert rows(N.team_reach(edges)) == [
        ("A", "B", 1), ("A", "C", 2), ("B", "A", 2), ("B", "C", 1), ("C", "A", 1), ("C", "B", 2),
    ]


def test_ids_that_start_alike_are_told_apart(spark, rows):
    matches = spark.createDataFrame([(5, 10), (10, 1)], "team_a_id long, team_b_id long")
    assert ("5->10->1",) in rows(N.team_network(matches), "full_path")


@pytest.mark.parametrize("n", [5, 9])
def test_path_counts(spark, rows, n):
    """As many paths as there are when they are listed."""
    rng = random.Random(n)
    links = [(a, b) for a in range(n) for b in range(n) if rng.random() < 0.5] + [(0, 1), (0, 1), (n, n), (50, None)]
    edges = spark.createDataFrame(links, "src long, dst long")
    listed = N.team_paths(edges, 8).groupBy("team_id", "reached_id", "level").count()
    columns = ("team_id", "reached_id", "level")
    listed = listed.filter("reached_id IS NOT NULL")
    assert rows(N.team_path_counts(edges, 8), *columns, "n_paths") == rows(listed, *columns, "count")


def test_path_counts_of_a_full_network(spark):
    """Eight levels on twelve teams that all meet: 12 * 11 * ... * 4 paths, held as a few thousand sets."""
    edges = spark.range(12).crossJoin(spark.range(12).withColumnRenamed("id", "dst")).withColumnRenamed("id", "src")
    counts = N.team_path_counts(edges, 8).groupBy("level").agg(F.sum("n_paths").alias("n")).collect()
    assert {r.level: r.n for r in counts} == {k: math.perm(12, k + 1) for k in range(1, 9)}
