import random
import shutil
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchboard.operators import ratelimit
from matchboard.operators.analytics import team_counters
from matchboard.operators.changes import audit_feed
from matchboard.operators.ratelimit import rate_limit
from matchboard.operators.skew import HotGroup
from matchboard.sources.results import leaderboard_snapshot
from matchboard.streaming import feeds
from matchboard.streaming.state import KeyedState


def land(df, folder, parts, order):
    """Write a table as files that arrive one after the other in the given order."""
    bounds = df.approxQuantile(order, [i / parts for i in range(1, parts)], 0.0)
    edges = [float("-inf"), *bounds, float("inf")]
    for low, high in zip(edges, edges[1:]):
        part = df.filter((F.col(order) > low) & (F.col(order) <= high))
        part.coalesce(1).write.mode("append").parquet(folder)


def reader(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_new_matches_arrive_once(spark, tables, tmp_path):
    folder, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    matches = tables["matches"]
    land(matches.filter("id < 700"), folder, 2, "id")
    feeds.load_new_matches(reader(spark, folder, matches.schema), out, log)
    assert spark.read.parquet(out).count() == 700
    feeds.load_new_matches(reader(spark, folder, matches.schema), out, log)  # nothing new
    matches.filter("id >= 600").coalesce(1).write.mode("append").parquet(folder)  # 100 of them again
    feeds.load_new_matches(reader(spark, folder, matches.schema), out, log)
    stored = spark.read.parquet(out)
    assert stored.count() == matches.count() == stored.select("id").distinct().count()


def test_restart_without_progress_stores_nothing_twice(spark, tables, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    matches = tables["matches"]
    matches.coalesce(1).write.parquet(folder)
    for attempt in range(2):  # the second run has lost the first one's checkpoint
        feeds.load_new_matches(reader(spark, folder, matches.schema), out, str(tmp_path / f"log{attempt}"))
    assert spark.read.parquet(out).count() == matches.count()


def test_repeats_within_the_delay(spark, tmp_path):
    rows = spark.range(600).select("id", (F.lit("2024-01-01").cast("timestamp")).alias("ts"))
    folder = str(tmp_path / "in")
    rows.coalesce(1).write.parquet(folder)
    rows.filter("id < 300").coalesce(1).write.mode("append").parquet(folder)
    once = feeds.drop_repeats(reader(spark, folder, rows.schema), "id", "ts", "1 day")
    feeds.append_batches(once, str(tmp_path / "out"), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 600


def test_counters_over_several_batches(spark, tables, tmp_path, rows):
    folder, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    matches = tables["matches"]
    land(matches.filter("id < 1000"), folder, 3, "id")
    feeds.count_teams(reader(spark, folder, matches.schema), out, log)
    matches.filter("id >= 1000").coalesce(1).write.mode("append").parquet(folder)
    feeds.count_teams(reader(spark, folder, matches.schema), out, log)
    assert rows(feeds.counters_now(matches, out)) == rows(team_counters(matches))


def test_audit_over_several_batches(spark, tables, tmp_path, rows):
    folder, out, state, log = (str(tmp_path / n) for n in ("in", "out", "state", "log"))
    changes = tables["player_changes"]
    land(changes, folder, 4, "version")
    feeds.audit_changes(
        reader(spark, folder, changes.schema), out, state, log, "id", "version", ["elo_rating"], "players"
    )
    got = spark.read.option("basePath", out).parquet(out).drop("batch")
    assert rows(got) == rows(audit_feed(changes, "id", "version", ["elo_rating"], "players"))


@pytest.mark.parametrize("way", ["state", "batches", "hot batches"])
def test_rate_limit_over_several_batches(spark, tmp_path, rows, monkeypatch, way):
    rng = random.Random(5)
    times = sorted(rng.randrange(600) for _ in range(400))
    calls = spark.createDataFrame(
        [(rng.randrange(3), i, t) for i, t in enumerate(times)], "user_id long, event_id long, s long"
    ).select("user_id", "event_id", F.timestamp_seconds("s").alias("ts"))
    expected = rows(rate_limit(calls, "user_id", "ts", "event_id", 5, 60), "user_id", "event_id", "allowed")
    if way == "hot batches":
        monkeypatch.setattr(ratelimit, "hot_groups", lambda *_: [HotGroup((1,), 3_000_000), HotGroup((2,), 9)])
    folder, out, state, log = (str(tmp_path / n) for n in ("in", "out", "state", "log"))

    def run():
        source, columns = reader(spark, folder, calls.schema), ("user_id", "ts", "event_id", 5, 60)
        if way == "state":
            feeds.limit_rate_in_state(source, out, log, *columns)
        else:
            feeds.limit_rate(source, out, state, log, *columns)

    land(calls.filter("event_id < 300"), folder, 3, "event_id")
    run()
    calls.filter("event_id >= 300").coalesce(1).write.mode("append").parquet(folder)
    run()
    assert rows(spark.read.option("basePath", out).parquet(out), "user_id", "event_id", "allowed") == expected


def test_leaderboard_follows_new_players(spark, tables, tmp_path):
    folder, table, board, log = (str(tmp_path / n) for n in ("in", "table", "board", "log"))
    players = tables["players"]
    land(players, folder, 3, "id")
    feeds.refresh_leaderboard(reader(spark, folder, players.schema), table, board, log)
    assert spark.read.parquet(board).count() == min(500, players.count())


def test_leaderboard_follows_changed_ratings(spark, tmp_path):
    folder, table, board, log = (str(tmp_path / n) for n in ("in", "table", "board", "log"))
    schema = "id long, username string, country string, elo_rating int, created_at timestamp_ntz"
    for rating in (2000, 1500, 1000):
        row = f"SELECT 1L AS id, 'a' AS username, 'x' AS country, {rating} AS elo_rating, TIMESTAMP_NTZ'2024-01-01' AS created_at"
        spark.sql(row).write.mode("append").parquet(folder)
        feeds.refresh_leaderboard(reader(spark, folder, schema), table, board, log)
        assert [r["elo_rating"] for r in spark.read.parquet(board).collect()] == [rating]


@pytest.mark.parametrize("way", ["batches", "state"])
def test_late_calls_are_put_aside(spark, tmp_path, rows, way):
    folder, out, state, log = (str(tmp_path / n) for n in ("in", "out", "state", "log"))
    batches = [[(1, 1, 1000), (2, 2, 1010)], [(1, 3, 990), (1, 4, 1030), (2, 5, 1005)], [(1, 6, 1100), (1, 7, None), (3, 8, 10)]]
    for calls in batches:
        frame = spark.createDataFrame(calls, "user_id long, event_id long, s long")
        frame = frame.select("user_id", "event_id", F.timestamp_seconds("s").alias("ts"))
        frame.coalesce(1).write.mode("append").parquet(folder)
        source = reader(spark, folder, frame.schema)
        if way == "state":
            feeds.limit_rate_in_state(source, out, log, "user_id", "ts", "event_id", 1, 60, 300)
        else:
            feeds.limit_rate(source, out, state, log, "user_id", "ts", "event_id", 1, 60, 300)
    late = spark.read.option("basePath", f"{out}-late").parquet(f"{out}-late")
    assert rows(late, "event_id") == [(3,), (5,), (7,), (8,)]
    decided = spark.read.option("basePath", out).parquet(out)
    assert rows(decided, "event_id", "allowed") == [(1, True), (2, True), (4, False), (6, True)]


def test_state_holds_open_windows_only(spark, tmp_path, rows):
    folder, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    batches = [[(user, 100 + user, 1000 + user) for user in range(50)], [(1, 1, 1030), (2, 2, 1031)], [(7, 3, 1500)], [(7, 4, 1501)], [(8, 5, 9000)]]
    held = []
    for calls in batches:
        frame = spark.createDataFrame(calls, "user_id long, event_id long, s long")
        frame = frame.select("user_id", "event_id", F.timestamp_seconds("s").alias("ts"))
        frame.coalesce(1).write.mode("append").parquet(folder)
        feeds.limit_rate_in_state(reader(spark, folder, frame.schema), out, log, "user_id", "ts", "event_id", 1, 60, 100)
        windows = spark.read.format("statestore").option("stateVarName", "window").load(log)
        held.append(sorted(r[0] for r in windows.select("key.user_id").collect()))
    assert held == [list(range(50)), list(range(50)), [7], [7], [8]]
    decided = spark.read.option("basePath", out).parquet(out)
    assert rows(decided.filter("event_id < 100"), "event_id", "allowed") == [(1, False), (2, False), (3, True), (4, False), (5, True)]


def test_calls_are_decided_as_they_come(spark, tmp_path, rows):
    """A key's micro-batch in several parts; the state carries the window from part to part."""
    folder, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    calls = spark.range(40).select(F.lit(1).alias("user_id"), F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"))
    calls.coalesce(1).write.parquet(folder)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "7")
    try:
        feeds.limit_rate_in_state(reader(spark, folder, calls.schema), out, log, "user_id", "ts", "event_id", 3, 10, 1)
    finally:
        spark.conf.set(setting, before)
    decided = spark.read.option("basePath", out).parquet(out)
    assert rows(decided, "event_id", "allowed") == sorted(((i, i % 10 < 3) for i in range(40)), key=repr)


def test_leaderboard_from_changes_alone(spark, tmp_path, monkeypatch):
    """The stored players are read whole only when someone falls off a full board."""
    monkeypatch.setattr(feeds, "MAX_LEADERBOARD", 3)
    monkeypatch.setattr(feeds, "leaderboard_snapshot", lambda players, path: leaderboard_snapshot(players, path, 3))
    whole = []
    monkeypatch.setattr(feeds.KeyedState, "rows", lambda self, n, own=feeds.KeyedState.rows: whole.append(n) or own(self, n))
    folder, table, board, log = (str(tmp_path / n) for n in ("in", "table", "board", "log"))
    schema = "id long, username string, country string, elo_rating int, created_at timestamp"
    batches = [[(1, 10), (2, 20)], [(3, 30), (4, 5)], [(5, 25), (6, 5)], [(3, 1)], [(9, None), (8, 20), (4, 20)], [(7, 99), (5, 98)]]
    now, boards = {}, []
    for at, batch in enumerate(batches):
        now |= dict(batch)
        rows = [(i, "u", "c", elo, datetime(2024, 1, 1 + at)) for i, elo in batch]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        feeds.refresh_leaderboard(reader(spark, folder, schema), table, board, log)
        boards.append([int(r.player_id) for r in spark.read.parquet(board).collect()])
        best = sorted(now, key=lambda i: (-(now[i] or -1), i))[:3]
        assert sorted(boards[-1]) == sorted(best)
    assert whole == [0, 3]


def test_keyed_state_rewrites_only_what_changed(spark, tmp_path):
    folder = str(tmp_path / "state")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.LongType())])
    state = KeyedState(spark, folder, "id", schema, parts=32)
    state.put(0, spark.range(100_000).select("id", F.lit(0).cast("long").alias("v")))
    expected, first = dict.fromkeys(range(100_000), 0), {p: p.stat().st_mtime_ns for p in tmp_path.rglob("delta-0/part=*/*.parquet")}
    for batch in range(1, 12):
        keys = [batch % 3, 7, 50_000 + batch]
        expected |= dict.fromkeys(keys, batch)
        changed = spark.createDataFrame([(k, batch) for k in keys], schema)
        if batch in (4, 9):  # delivered twice
            state.put(batch, changed)
        state.put(batch, changed)
        assert {r.id: r.v for r in state.rows_of(changed, batch).collect()} == dict.fromkeys(keys, batch)
        delta = spark.read.parquet(f"{folder}/runs/delta-{batch}")
        assert delta.count() == 3
    assert state.newest() == 11 and {r.id: r.v for r in state.rows(11).collect()} == expected
    runs = state.runs(11)
    per_part = Counter(r.part for r in runs)
    assert len(per_part) == 32 and max(per_part.values()) <= 7 and any(r.level for r in runs)
    kept = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("delta-0/part=*/*.parquet")}
    assert len(kept) >= 24 and kept.items() <= first.items()  # parts that no batch filled up are as they were
    assert sorted(p.name for p in (tmp_path / "state" / "manifest").iterdir()) == ["batch=10", "batch=11"]


def test_lost_state_is_an_error(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType())])
    state = KeyedState(spark, str(tmp_path / "state"), "id", schema)
    state.put(0, spark.range(10))
    with pytest.raises(ValueError, match="missing"):
        state.rows_of(spark.range(3), 1)
    with pytest.raises(ValueError, match="parts"):
        KeyedState(spark, str(tmp_path / "state"), "id", schema, parts=3).rows(0)
    shutil.rmtree(next((tmp_path / "state").glob("runs/delta-0/part=*")))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        state.rows(0).count()
