"""Hot groups: the spread-out paths give the same rows as the plain ones."""

import random
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matchboard.operators import analytics as A
from matchboard.operators import skew as S
from matchboard.operators import ratelimit
from matchboard.operators.ratelimit import rate_limit


@pytest.fixture(scope="module")
def stats(spark):
    """A third of all rows in match 5, a third of those of one player, the rest spread."""
    rng = random.Random(1)
    data = []
    for i in range(6000):
        match = 5 if i % 3 == 0 else rng.randrange(400)
        player = 77 if i % 9 == 0 else rng.randrange(3000)
        data.append((match, player, None if i % 50 == 0 else Decimal(rng.randrange(1000))))
    return spark.createDataFrame(data, "match_id long, player_id long, damage_dealt decimal(12,2)")


def test_hot_groups_are_found(stats):
    hot = S.hot_groups(stats, ["match_id"], min_rows=500)
    assert [g.key for g in hot] == [(5,)]
    assert hot[0].rows >= 2000
    assert S.hot_groups(stats, ["match_id"]) == []  # far too few rows to matter


def test_hot_rows_and_the_others(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "a"), (None, None), (2, "b")], "k long, t string")
    single = [S.HotGroup((2,), 1), S.HotGroup((None,), 1)]
    assert rows(S.only_hot(df, ["k"], single)) == [(2, "b"), (None, "a"), (None, None)]
    assert rows(S.without_hot(df, ["k"], single)) == [(1, "a"), (1, None)]
    many = [S.HotGroup((i, "x"), 1) for i in range(399)] + [S.HotGroup((1, None), 1), S.HotGroup((2, "b"), 1)]
    assert rows(S.only_hot(df, ["k", "t"], many)) == [(1, None), (2, "b")]
    assert S.without_hot(df, ["k", "t"], many).count() == 3
    assert S.only_hot(df, ["k"], []).isEmpty() and S.without_hot(df, ["k"], []).count() == 5


def test_many_even_groups_are_all_cut(spark, rows):
    """500 groups of 0.2 % each, all above the bound."""
    df = spark.range(500 * 40).select((F.col("id") % 500).alias("k"), F.col("id").alias("v"))
    hot = S.hot_groups(df, ["k"], min_rows=30)
    assert len(hot) == 500
    plain = S.position_in_group(df, ["k"], ["v"], "place", [])
    assert rows(S.position_in_group(df, ["k"], ["v"], "place", hot)) == rows(plain)


def test_avg_damage(stats, rows):
    hot = S.hot_groups(stats, ["match_id"], min_rows=500)
    assert rows(A.avg_damage(stats, hot, rows_per_segment=100)) == rows(A.avg_damage(stats, []))


def test_pieces_are_balanced_whatever_the_values(spark):
    """Nearly all rows within one second of ten years."""
    value = F.when(F.col("id") == 0, 0.0).otherwise(1e9 + F.col("id"))
    df = spark.range(4000).select(F.lit(1).alias("k"), value.alias("v"))
    cut = S.add_segment(df, ["k"], ["v"], [S.HotGroup((1,), 4000)], 500)
    sizes = [r["count"] for r in cut.groupBy(S.SEGMENT).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) >= 7 and max(sizes) < 1200
    edges = cut.groupBy(S.SEGMENT).agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy(S.SEGMENT).collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(edges, edges[1:]))


def test_avg_damage_with_text_ids(stats, rows):
    named = stats.withColumn("player_id", F.md5(F.col("player_id").cast("string").cast("binary")))
    hot = S.hot_groups(named, ["match_id"], min_rows=500)
    assert rows(A.avg_damage(named, hot, rows_per_segment=100)) == rows(A.avg_damage(named, []))


def test_avg_damage_counts_rows_of_one_player_together(spark, rows):
    df = spark.createDataFrame([(1, 1, 10), (1, 1, 30), (1, 2, 50)], "match_id long, player_id long, damage_dealt int")
    assert rows(A.avg_damage(df, [])) == [(1, 1, 20.0), (1, 1, 20.0), (1, 2, 30.0)]
    assert rows(A.avg_damage(df, [S.HotGroup((1,), 3)], 1)) == [(1, 1, 20.0), (1, 1, 20.0), (1, 2, 30.0)]


def test_repeating_rows_in_steps(spark, rows, monkeypatch):
    monkeypatch.setattr(A, "_REPEAT_STEP", 7)
    df = spark.createDataFrame([(1, 1), (2, 7), (3, 8), (4, 50)], "k long, n long")
    assert rows(A._repeat(df, "n").groupBy("k").count()) == [(1, 1), (2, 7), (3, 8), (4, 50)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_skew_joins(spark, stats, rows, how):
    matches = spark.range(300).select(F.col("id").alias("match_id"), (F.col("id") * 2).alias("tournament_id"))
    players = spark.range(2500).select(F.col("id").alias("player_id"), (F.col("id") * 3).alias("elo"))
    lookups = [S.Lookup(matches, ("match_id",), how), S.Lookup(players, ("player_id",), how)]
    plain = stats.join(matches, "match_id", how).join(players, "player_id", how)
    spread = S.skew_joins(stats, lookups, min_rows=300, broadcast_rows=0)
    assert "__salt" in spread._jdf.queryExecution().analyzed().toString()
    assert rows(spread, *plain.columns) == rows(plain)
    small = S.skew_joins(stats, lookups)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert rows(small, *plain.columns) == rows(plain)


def test_positions_and_previous_values(stats, rows):
    numbered = stats.withColumn("row", F.monotonically_increasing_id()).select("match_id", "row")
    hot = S.hot_groups(numbered, ["match_id"], min_rows=500)
    many = [S.HotGroup(g.key, 50_000_000) for g in hot]  # more pieces than there are rows to fill them
    for groups in (hot, many):
        got = S.position_in_group(numbered, ["match_id"], ["row"], "place", groups)
        assert rows(got) == rows(S.position_in_group(numbered, ["match_id"], ["row"], "place", []))
        got = S.previous_in_group(numbered, ["match_id"], "row", "row", "before", groups)
        assert rows(got) == rows(S.previous_in_group(numbered, ["match_id"], "row", "row", "before", []))


def test_streaks_from_histories_in_texts(spark, tables, rows):
    matches = tables["matches"].withColumn("tournament_id", F.lit(1)).withColumn("team_a_id", F.col("team_a_id") % 2)
    won = spark.range(25_000).select(  # 25,000 wins in a row, and 24,000 after a loss
        (F.lit(10**6) + F.col("id")).alias("id"),
        F.lit(2).alias("tournament_id"),
        F.explode(F.sequence(F.lit(7).cast("long"), F.lit(8).cast("long"))).alias("team_a_id"),
        F.lit(9).cast("long").alias("team_b_id"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("played_at"),
    )
    winner = F.when((F.col("team_a_id") == 8) & (F.col("id") == 10**6 + 999), F.col("team_b_id"))
    won = won.withColumn("winner_id", winner.otherwise(F.col("team_a_id")))
    both = matches.unionByName(won)
    expected = rows(A.current_streak(both))
    assert (2, 7, 25_000) in expected and (2, 8, 24_000) in expected
    assert rows(A.streak_from_history(both)) == expected
    hot = [S.HotGroup((1, 0), 10_000_000), S.HotGroup((2, 7), 25_000)]
    assert rows(A.streak_from_history(both, rows_per_text=100, hot=hot)) == expected


def test_streaks_without_broadcast(tables, rows, monkeypatch):
    matches = tables["matches"]
    expected = rows(A.team_summary(matches))
    monkeypatch.setattr(A, "FEW_GROUPS", 0)
    assert rows(A.team_summary(matches, min_rows=3)) == expected


def test_streak_edges(spark, rows):
    data = [
        (1, 1, 1, 10, "2020-01-01"), (2, 1, 1, 10, "2020-01-02"),  # all won
        (3, 1, 2, 10, "2020-01-02"), (4, 1, 2, 2, "2020-01-02"),  # same time: id decides
        (5, 1, 3, 3, "2020-01-05"), (6, 1, 3, 9, "2020-01-06"),  # ends with a loss
        (7, 1, 4, None, "2020-01-07"), (8, 1, 4, 4, "2020-01-08"),  # no winner ends a streak, is no loss
    ]
    df = spark.createDataFrame(
        [(i, t, team, team if w == 10 else w, at) for i, t, team, w, at in data],
        "id long, tournament_id long, team_a_id long, winner_id long, played_at string",
    ).withColumn("played_at", F.col("played_at").cast("timestamp_ntz"))
    got = A.team_summary(df).drop("tournament_id")
    assert rows(got) == [(1, 2, 2, 0, 2), (2, 2, 2, 0, 2), (3, 2, 1, 1, 0), (4, 2, 1, 0, 1)]


@pytest.mark.parametrize("seed", range(60))
def test_windows_of_whole_batches(seed):
    """Decisions of sorted rows at once against a walk call by call: ties, open windows, batches that cut a group."""
    rng = random.Random(seed)
    width, spread, size = rng.choice([1, 5, 60, 2**55]), rng.choice([3, 40, 1000]), rng.choice([1, 3, 7, 1000])
    data = []
    for group in "abcd"[: rng.randint(1, 4)]:
        for chunk in range(rng.randint(1, 3)):
            if rng.random() < 0.5:
                data.append((group, chunk, ratelimit.NO_WINDOW, rng.randint(-10, spread + rng.choice([0, 100])), rng.randint(0, 5)))
            data += sorted((group, chunk, rng.randint(0, spread), None, None) for _ in range(rng.randint(0, 30)))
    expected, at, end, used = [], None, ratelimit.NO_WINDOW, 0
    for group, chunk, t, entered, counted in data:
        if (group, chunk) != at:
            at, end, used = (group, chunk), ratelimit.NO_WINDOW, 0
        if counted is not None:
            end, used = entered, counted
            continue
        if t >= end:
            end, used = t + width, 0
        used += 1
        expected.append((end, used, used <= 2))
    names = ratelimit._HELPERS
    schema = pa.schema([(names[0], pa.string()), *[(n, pa.int64()) for n in names[1:]]])
    whole = pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in data], schema)
    parts = (whole.slice(low, size) for low in range(0, len(data), size))
    got = [row for b in ratelimit._walk(parts, 2, width) for row in zip(*(b[c].to_pylist() for c in ("window_end", "calls", "allowed")))]
    assert got == expected


def brute_force(calls, max_calls, seconds):
    allowed, end, used = [], None, 0
    for t in calls:
        if end is None or t >= end:
            end, used = t + seconds, 0
        used += 1
        allowed.append(used <= max_calls)
    return allowed


def as_events(spark, calls):
    data = [(user, i, float(t)) for i, (user, t) in enumerate(calls)]
    return spark.createDataFrame(data, "user_id long, event_id long, s double").withColumn(
        "ts", F.timestamp_micros((F.col("s") * 1_000_000).cast("long"))
    )


def test_rate_limit_window_edge(spark):
    df = as_events(spark, [(1, t) for t in (0, 10, 20, 59, 60, 61, 62)])
    got = rate_limit(df, "user_id", "ts", "event_id", 2, 60).orderBy("event_id").collect()
    assert [r["allowed"] for r in got] == [True, True, False, False, True, True, False]


@pytest.mark.parametrize("case", range(14))
def test_rate_limit_of_hot_keys(spark, tmp_path, case):
    rng = random.Random(case)
    seconds, max_calls = rng.choice([5, 60]), rng.choice([1, 2, 7])
    spread = rng.choice([3, 40, 1000, 20000])
    grid = rng.choice([0, 1])  # many calls at the same moment
    calls = [(user, t if not grid else float(int(t))) for user in (1, 1, 1, 2, 3) for t in
             (rng.random() * spread for _ in range(60))]
    calls.sort(key=lambda c: c[1])
    df = as_events(spark, calls)
    if case >= 8:  # from files in many pieces, sizes unknown to the planner
        df.repartition(6).write.parquet(str(tmp_path / "calls"))
        df = spark.read.parquet(str(tmp_path / "calls"))
    hot = [S.HotGroup((1,), rng.choice([10, 180, 5000])), S.HotGroup((2,), 60)]
    got = rate_limit(df, "user_id", "ts", "event_id", max_calls, seconds, hot=hot, rows_per_chunk=rng.choice([5, 20]))
    got = {r["event_id"]: r["allowed"] for r in got.collect()}
    for user in (1, 2, 3):
        ids = [i for i, c in enumerate(calls) if c[0] == user]
        expected = brute_force([int(calls[i][1] * 1_000_000) for i in ids], max_calls, seconds * 1_000_000)
        assert [got[i] for i in ids] == expected
