"""Declared tables: column types, keys, references and value rules."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()
_TS, _D, _B = T.TimestampType(), T.DateType(), T.BooleanType()
MONEY, AMOUNT, PERCENT = T.DecimalType(15, 2), T.DecimalType(12, 2), T.DecimalType(5, 2)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


TABLES: dict[str, T.StructType] = {
    "players": _table(id=_S, username=_S, country=_S, date_of_birth=_D, elo_rating=_I, created_at=_TS),
    "teams": _table(id=_S, name=_S, region=_S, founded_at=_D, prize_pool=MONEY, is_active=_B),
    "team_rosters": _table(id=_L, team_id=_S, player_id=_S, role=_S, joined_at=_D, left_at=_D),
    "tournaments": _table(id=_S, name=_S, game=_S, prize_pool=MONEY, starts_at=_TS, status=_S),
    "matches": _table(
        id=_S, tournament_id=_S, team_a_id=_S, team_b_id=_S, winner_id=_S, played_at=_TS, created_by=_S
    ),
    "player_stats": _table(
        id=_I, match_id=_S, player_id=_S, kills=_I, deaths=_I, assists=_I, damage_dealt=AMOUNT, headshot_pct=PERCENT
    ),
    "elo_history": _table(id=_I, player_id=_S, match_id=_S, elo_before=_I, elo_after=_I, changed_at=_TS),
    "prize_payouts": _table(id=_I, tournament_id=_S, team_id=_S, player_id=_S, amount=AMOUNT, paid_at=_TS),
    "player_bans": _table(id=_I, player_id=_S, reason=_S, banned_at=_TS, expires_at=_TS, is_permanent=_B),
    "audit_log": _table(id=_L, table_name=_S, operation=_S, old_data=_S, new_data=_S, changed_at=_TS),
    "watermark_pipeline": _table(id=_L, point_of_time=_TS),
    "pipeline_watermarks": _table(point_of_time=_TS),
    "new_matches": _table(
        id=_S, tournament_id=_S, team_a_id=_S, team_b_id=_S, winner_id=_S, played_at=_TS, created_by=_S, loaded_at=_TS
    ),
}

# The statuses a tournament may have.
TOURNAMENT_STATUSES = ("upcoming", "ongoing", "completed", "cancelled")

PRIMARY_KEYS = {
    "players": ("id",),
    "teams": ("id",),
    "team_rosters": ("id",),
    "tournaments": ("id",),
    "matches": ("id",),
    "player_stats": ("id",),
    "elo_history": ("id",),
    "prize_payouts": ("id", "player_id"),
    "player_bans": ("id",),
}

# child table, child column, parent table (always its id)
FOREIGN_KEYS = (
    ("team_rosters", "team_id", "teams"),
    ("team_rosters", "player_id", "players"),
    ("matches", "tournament_id", "tournaments"),
    ("matches", "team_a_id", "teams"),
    ("matches", "team_b_id", "teams"),
    ("matches", "winner_id", "teams"),
    ("player_stats", "match_id", "matches"),
    ("player_stats", "player_id", "players"),
    ("elo_history", "player_id", "players"),
    ("elo_history", "match_id", "matches"),
    ("prize_payouts", "tournament_id", "tournaments"),
    ("prize_payouts", "team_id", "teams"),
    ("prize_payouts", "player_id", "players"),
    ("player_bans", "player_id", "players"),
)
