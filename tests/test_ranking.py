import random

import pytest
from pyspark.sql import functions as F

from matchboard.operators import analytics as A
from matchboard.operators import ranking as R


@pytest.fixture
def players(spark):
    return spark.createDataFrame(
        [(1, "a", "X", 10), (2, "b", "Y", 10), (3, "c", None, 9)],
        "id long, username string, country string, elo_rating int",
    )


def test_ties(players, rows):
    assert rows(A.leaderboard(players, 3), "player_id", "rank") == [("1", 1), ("2", 1), ("3", 3)]
    assert rows(A.top_players_ranked(players, 3), "id", "dense_rank") == [(1, 1), (2, 1), (3, 2)]
    assert rows(A.leaderboard(players, 3, "positional"), "player_id", "rank") == [("1", 2), ("2", 1), ("3", 3)]


@pytest.mark.parametrize("limit", [0, 501])
def test_limit_is_checked(players, limit):
    with pytest.raises(ValueError):
        A.leaderboard(players, limit)


@pytest.mark.parametrize("few", ["rows", "scores", "neither"])
@pytest.mark.parametrize("kind", ["rank", "dense"])
def test_rank_by_score(spark, rows, monkeypatch, few, kind):
    if few != "rows":
        monkeypatch.setattr(R, "FEW_ROWS", 0)
    if few == "neither":
        monkeypatch.setattr(R, "FEW_SCORES", 0)
    rng = random.Random(3)
    scores = [rng.choice([None, 1200, rng.randrange(-50, 4000)]) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(scores)), "id long, score int")
    order = sorted(scores, key=lambda s: (s is None, -(s or 0)))
    if kind == "rank":
        expected = {s: order.index(s) + 1 for s in scores}
    else:
        expected = {s: i for i, s in enumerate(dict.fromkeys(order), start=1)}
    assert rows(R.rank_by_score(df, "score", kind), "id", "rank") == sorted(
        ((i, expected[s]) for i, s in enumerate(scores)), key=repr
    )


def test_zip_with_index_and_permutation(spark, rows):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("id"))
    assert rows(R.zip_with_index(df, [F.desc("id")])) == sorted(((i, 500 - i) for i in range(500)), key=repr)
    from matchboard.plans.generate import permutation

    shuffled = permutation(df, "p").collect()
    assert sorted(r["rn"] for r in shuffled) == list(range(1, 501))
    assert [r["rn"] for r in sorted(shuffled)] != list(range(1, 501))


def test_bucket_assign_drops_members_past_the_last_bucket(spark, rows):
    members, buckets = spark.range(20).toDF("m"), spark.range(3).toDF("b")
    got = R.bucket_assign(members, buckets, 6, [F.asc("m")], [F.asc("b")])
    assert rows(got, "m", "b") == sorted(((m, m // 6) for m in range(18)), key=repr)


def test_top_n_per_key(spark, rows):
    df = spark.createDataFrame([(7, m) for m in range(12)] + [(8, 1)], "player_id long, match_id long")
    got = A.last_n_per_player(df)
    assert got.filter("player_id = 7").count() == 10
    assert rows(got.filter("player_id = 7").agg(F.min("match_id"))) == [(2,)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_having(spark, rows):
    df = spark.createDataFrame([(1, 1)] * 3 + [(1, 2)] * 4, "tournament_id long, team_a_id long")
    assert rows(A.frequent_pairs(df)) == [(1, 2)]


def test_enriched_names(spark, rows, players):
    ranked = spark.createDataFrame([(1, "1", 10), (2, "99", 5)], "rank long, player_id string, elo_rating long")
    got = A.enrich_ranked(ranked, players)
    assert rows(got) == [(1, "1", "a", 10, "X"), (2, "99", "unknown", 5, None)]


def test_empty_inputs_keep_their_columns(spark, tables):
    for build in (A.avg_damage, A.top_kda, A.last_n_per_player):
        empty = build(tables["player_stats"].limit(0))
        assert empty.schema == build(tables["player_stats"]).schema and empty.count() == 0
    for build in (A.win_rate, A.team_summary, A.win_history, A.team_counters, A.frequent_pairs):
        empty = build(tables["matches"].limit(0))
        assert empty.schema.names == build(tables["matches"]).schema.names and empty.count() == 0
    assert R.rank_by_score(tables["players"].limit(0), "elo_rating").count() == 0
    assert A.leaderboard(tables["players"].limit(0)).count() == 0
