"""Invariants of the synthetic tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from matchboard.operators import analytics as A
from matchboard.operators import quality as Q
from matchboard.operators.network import team_edges, team_reach
from matchboard.operators.skew import HotGroup
from matchboard.plans import generate as G
from matchboard.plans.checks import check_models
from matchboard.plans.models import Models
from matchboard.schema import PRIMARY_KEYS, TOURNAMENT_STATUSES

NOW = "2026-05-17 00:00:00"


@pytest.fixture(scope="module")
def made(spark):
    players = G.gen_players(G.series(spark, 1, 500), NOW)
    teams = G.gen_teams(G.series(spark, 1, 50))
    tournaments = G.gen_tournaments(G.series(spark, 1, 100))
    matches = G.gen_matches(G.series(spark, 1, 1000), tournaments, teams, NOW)
    return {"players": players, "teams": teams, "tournaments": tournaments, "matches": matches}


def test_players(made):
    players = made["players"]
    assert players.count() == 500
    low, high = players.agg(F.min("elo_rating"), F.max("elo_rating")).first()
    assert 1080 <= low and high <= 1579
    assert players.filter(F.col("country").isNull() | F.col("date_of_birth").isNull()).count() == 0


def test_teams_and_tournaments(made):
    assert made["teams"].select("region").distinct().count() == 5
    assert made["teams"].filter("prize_pool NOT BETWEEN 50000 AND 100000").count() == 0
    assert made["tournaments"].filter(~F.col("status").isin(*TOURNAMENT_STATUSES)).count() == 0
    assert made["tournaments"].filter("year(starts_at) <> 2026").count() == 0


def test_matches(made):
    matches = made["matches"]
    assert matches.count() == 1000
    assert matches.filter("team_a_id = team_b_id OR winner_id NOT IN (team_a_id, team_b_id)").count() == 0
    wins = matches.filter("winner_id = team_a_id").count()
    assert 400 < wins < 600
    assert matches.select("team_a_id").distinct().count() == 50


@pytest.mark.parametrize("wide", [False, True])
def test_player_stats(made, wide):
    stats = G.gen_player_stats(made["matches"], made["players"], wide)
    first, last = stats.agg(F.min("id"), F.max("id")).first()
    assert (first, last) == ((1, 8000) if wide else (11, 10008))
    per_match = stats.groupBy("match_id").agg(F.count("*").alias("n"), F.countDistinct("player_id").alias("d"))
    assert per_match.filter("n <> 8 OR d <> 8").count() == 0 and per_match.count() == 1000
    assert stats.select("id").distinct().count() == stats.count()
    least = stats.agg(F.min("deaths")).first()[0]
    assert least == (0 if wide else 1)


def test_any_eight_players_meet(spark, made):
    """Pairs of players meet as often as chance has it, whatever their places in the list."""
    few = made["players"].orderBy("id").limit(16)
    stats = G.gen_player_stats(made["matches"], few).select("match_id", "player_id")
    pairs = stats.join(stats.withColumnRenamed("player_id", "other"), "match_id").filter("player_id < other")
    met = [r["count"] for r in pairs.groupBy("player_id", "other").count().collect()]
    expected = 1000 * 28 / 120
    assert len(met) == 120 and sum(met) == 28_000
    assert sum((n - expected) ** 2 / expected for n in met) < 119 + 4 * (2 * 119) ** 0.5
    single = [r["count"] for r in stats.groupBy("player_id").count().collect()]
    assert sum((n - 500) ** 2 / 500 for n in single) < 15 + 4 * 30**0.5


def test_different_numbers(spark):
    draws = spark.range(3000).select(G._different(3, 2, "t", "id").alias("d"), G._different(2, 2, "u", "id").alias("all")).collect()
    counts = Counter(frozenset(r.d) for r in draws)
    assert len(counts) == 3 and all(900 < n < 1100 for n in counts.values()) and all(sorted(r["all"]) == [0, 1] for r in draws)


def test_rosters(made):
    rosters = G.gen_rosters(made["players"], made["teams"])
    assert rosters.count() == 300  # 50 teams of six; the other players stay without a team
    assert rosters.groupBy("team_id").count().filter("count <> 6").count() == 0
    assert rosters.filter("left_at <> date_add(joined_at, 2)").count() == 0


def test_histories(made):
    stats = G.gen_player_stats(made["matches"].limit(50), made["players"])
    history = G.gen_elo_history(stats, made["players"], NOW)
    assert history.count() == 400
    assert history.filter("elo_after NOT BETWEEN 701 AND 1699").count() == 0
    bans = G.gen_bans(made["players"], NOW)
    assert 25 < bans.count() < 80
    assert bans.agg(F.max("id")).first()[0] == bans.count()
    payouts = G.gen_payouts(made["players"], made["teams"], made["tournaments"], NOW)
    assert payouts.count() == 50
    assert payouts.filter("amount NOT BETWEEN 50000 AND 99999").count() == 0


def test_too_few_rows_are_refused(spark, made):
    with pytest.raises(ValueError):
        G.gen_matches(G.series(spark, 1, 5), made["tournaments"], made["teams"].limit(1), NOW)
    with pytest.raises(ValueError):
        G.gen_player_stats(made["matches"], made["players"].limit(7))
    with pytest.raises(ValueError):
        G.gen_player_stats(made["matches"].limit(9), made["players"], wide=True)


def test_groups_of_a_match(made):
    stats = G.gen_player_stats(made["matches"].limit(20), made["players"], wide=True, groups=5)
    assert stats.groupBy("match_id").count().filter("count <> 40").count() == 0
    assert stats.count() == 800 == stats.select("id").distinct().count()


def test_ids_look_like_uuids(made):
    pattern = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    for name in ("players", "teams", "tournaments", "matches"):
        ids = made[name].select("id")
        assert ids.filter(~F.col("id").rlike(pattern)).count() == 0
        assert ids.distinct().count() == ids.count()


def test_generated_tables_feed_queries_models_and_checks(spark, made, tmp_path):
    """The whole path on text ids: generate, write, check references, build and test the models."""
    stats = G.gen_player_stats(made["matches"], made["players"])
    frames = {
        **made,
        "player_stats": stats,
        "team_rosters": G.gen_rosters(made["players"], made["teams"]),
        "elo_history": G.gen_elo_history(stats, made["players"], NOW),
        "prize_payouts": G.gen_payouts(made["players"], made["teams"], made["tournaments"], NOW),
        "player_bans": G.gen_bans(made["players"], NOW),
    }
    tables = {}
    for name, df in frames.items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))

    assert Q.foreign_keys(tables).count() == 0
    assert Q.unique(tables["prize_payouts"], list(PRIMARY_KEYS["prize_payouts"])).count() == 0
    report = {(r["model"], r["column_name"], r["check"]): r["passed"] for r in check_models(Models(tables)).collect()}
    report.pop(("prize_earnings", "id", "unique"))  # ties for the best team are kept
    assert len(report) == 19 and all(report.values())

    counters = A.team_counters(tables["matches"])
    assert counters.agg(F.sum("matches_played"), F.sum("matches_won")).first()[:] == (2000, 1000)
    assert A.avg_damage(tables["player_stats"]).count() == 8000
    hot = [HotGroup((tables["player_stats"].first()["match_id"],), 10**7)]
    assert A.avg_damage(tables["player_stats"], hot).exceptAll(A.avg_damage(tables["player_stats"], [])).isEmpty()
    latest = A.last_n_per_player(tables["player_stats"])
    assert latest.groupBy("player_id").count().filter("count > 10").isEmpty()
    assert A.most_improved(tables["elo_history"], NOW).count() == 1
    assert A.leaderboard(tables["players"], 500).count() == 500
    network = team_reach(team_edges(tables["matches"]))
    assert network.count() == 50 * 49 and network.agg(F.max("hops")).first()[0] <= 3


@pytest.mark.parametrize("at_most", [1 << 23, 10])
def test_ids_by_position_in_blocks_and_shuffled(spark, monkeypatch, at_most):
    monkeypatch.setattr(G, "BLOCK_BITS", 4)
    monkeypatch.setattr(G, "BROADCAST_IDS", at_most)
    ids = spark.range(100).select((F.col("id") * 7 + 3).alias("id"))
    rows = spark.range(1000).select((F.col("id") * 37 % 100).alias("player_id_at"))
    found = G._with_id_at(rows, ids, "player_id")
    assert {(r.player_id_at, r.player_id) for r in found.collect()} == {(n, n * 7 + 3) for n in range(100)} and found.count() == 1000


def test_statistics_are_made_in_as_many_tasks_as_a_shuffle_has(spark):
    matches, players = (spark.range(n).select("id") for n in (200, 40))
    made = G.gen_player_stats(matches.coalesce(1), players, wide=True, groups=2)
    tasks = made.select(F.spark_partition_id().alias("t")).distinct().count()
    assert made.count() == 3200 and tasks > 1
