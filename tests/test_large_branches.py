"""The plans for large tables, forced on the small ones, against the comparison SQL."""

import duckdb
import pytest

import check
from conftest import DATA
from matchboard import cluster
from matchboard.catalog import QUERIES
from matchboard.operators import analytics, ranking, ratelimit, skew
from matchboard.oracle import ORACLE
from matchboard.sources import writers

SMALLER = {skew.HOT_ROWS: 60, skew.SEGMENT_ROWS: 40, skew.BROADCAST_ROWS: 1}
NAMES = (
    "avg_damage current_streak win_history team_counters int_player_match_summary int_team_match_summary player_performance "
    "tournament_standings prize_earnings dense_rank_all leaderboard_global surrogate_ids audit_feed rate_limit gen_elo_history "
    "slow_queries zip_latest gen_player_stats fk_violations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in check.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
    return connection


@pytest.fixture
def large(monkeypatch):
    monkeypatch.setattr(ranking, "FEW_ROWS", 1)
    monkeypatch.setattr(ranking, "FEW_SCORES", 1)
    monkeypatch.setattr(analytics, "FEW_GROUPS", 1)
    changed = 0
    for module in (analytics, ranking, ratelimit, skew, writers, cluster):
        for function in vars(module).values():
            defaults = getattr(function, "__defaults__", None)
            if defaults and function.__module__ == module.__name__ and any(type(d) is int and d in SMALLER for d in defaults):
                monkeypatch.setattr(function, "__defaults__", tuple(SMALLER.get(d, d) if type(d) is int else d for d in defaults))
                changed += 1
    assert changed >= 8


@pytest.mark.parametrize("name", [n for n in NAMES if n in QUERIES])
def test_query(spark, duck, large, name):
    got, expected = QUERIES[name](spark, DATA).toArrow(), duck.execute(ORACLE[name]).to_arrow_table()
    assert check.shape(got) == check.shape(expected) and check.rows(got) == check.rows(expected)


def test_names():
    assert sum(n in QUERIES for n in NAMES) >= 17
