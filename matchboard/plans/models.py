"""Staging views, intermediate views and mart tables.

A model is a function from the tables to a DataFrame; Catalyst folds the layers into one plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..cluster import cut_lineage
from ..functions import kda, kda_hundredths, ratio_pct, rounded_div
from ..operators.analytics import team_summary
from ..operators.ranking import rank_by_score
from ..operators.skew import Lookup, skew_join, skew_joins

MIN_CAREER_MATCHES = 3  # fixed value: fewer matches give no career row


def stg_players(tables) -> DataFrame:
    return tables["players"].select("id", "username", "country", "date_of_birth", "elo_rating", "created_at")


def stg_teams(tables) -> DataFrame:
    return tables["teams"].select("id", "name", "region", F.round("prize_pool", 2).alias("prize_pool"))


def stg_tournaments(tables) -> DataFrame:
    return tables["tournaments"].select(
        "id", "name", "game", F.round("prize_pool", 2).alias("prize_pool"), "starts_at", "status"
    )


def stg_matches(tables) -> DataFrame:
    return tables["matches"].select(
        F.col("id").alias("match_id"), "tournament_id", "team_a_id", "team_b_id", "winner_id", "played_at"
    )


def stg_player_stats(tables) -> DataFrame:
    return tables["player_stats"].select(
        F.col("id").alias("stat_id"),
        "match_id",
        "player_id",
        "kills",
        "deaths",
        "assists",
        "damage_dealt",
        "headshot_pct",
        kda("kills", "assists", "deaths").alias("kda"),
    )


def int_player_match_summary(tables) -> DataFrame:
    """Each statistics row with its player and match. Hot matches and players are spread out.

    What follows from other columns is worked out after the joins, so that it is not shuffled.
    """
    stats = stg_player_stats(tables).drop("kda")
    matches = stg_matches(tables).select("match_id", "tournament_id", "played_at")
    players = stg_players(tables).select(F.col("id").alias("player_id"), "username", "country", "elo_rating")
    joined = skew_joins(stats, [Lookup(matches, ("match_id",)), Lookup(players, ("player_id",))])
    return joined.select(
        "stat_id",
        "match_id",
        "player_id",
        "username",
        "country",
        "elo_rating",
        "tournament_id",
        "played_at",
        "kills",
        "deaths",
        "assists",
        kda("kills", "assists", "deaths").alias("kda"),
        (F.col("kills") + F.col("assists")).alias("total_contribution"),
    )


def int_team_match_summary(tables) -> DataFrame:
    """Matches, wins, losses and current streak per (tournament, first team).

    Tournaments serve as an existence test only, made on one row per group.
    """
    known = stg_tournaments(tables).select(F.col("id").alias("tournament_id"))
    return team_summary(tables["matches"]).join(known, "tournament_id", "left_semi")


def player_performance(tables) -> DataFrame:
    """Career numbers of players with enough matches, ranked by rating.

    Statistics are added up per player before the player columns are joined, so a player with very many
    rows is one row in that join.
    """
    stats = tables["player_stats"].select(
        "match_id", "player_id", "kills", kda_hundredths("kills", "assists", "deaths").alias("kda")
    )
    played = skew_join(stats, stg_matches(tables).select("match_id"), ["match_id"], "left_semi")
    sums = played.groupBy("player_id").agg(
        F.count(F.lit(1)).alias("total_matches"),
        F.sum("kills").cast("long").alias("total_kills"),
        F.count("kills").alias("n_kills"),
        F.sum("kda").alias("sum_kda"),
        F.count("kda").alias("n_kda"),
    )
    career = sums.select(
        "player_id",
        "total_matches",
        "total_kills",
        (rounded_div(F.col("total_kills") * 100, "n_kills") / 100.0).alias("avg_kills"),
        (rounded_div("sum_kda", "n_kda") / 100.0).alias("career_kda"),
    )
    players = stg_players(tables).select(F.col("id").alias("player_id"), "username", "country", "elo_rating")
    joined = career.filter(F.col("total_matches") >= MIN_CAREER_MATCHES).join(players, "player_id")
    ranked = rank_by_score(cut_lineage(joined), "elo_rating", "rank", "global_rank")
    return ranked.select(
        "player_id",
        "username",
        "country",
        "elo_rating",
        "total_matches",
        "total_kills",
        "avg_kills",
        "career_kda",
        "global_rank",
    )


def tournament_standings(tables) -> DataFrame:
    """Totals per team over all tournaments with a dense rank by wins."""
    totals = (
        tables["int_team_match_summary"]
        .groupBy(F.col("team_a_id").alias("team_id"))
        .agg(
            F.sum("total_matches").alias("total_matches"),
            F.sum("wins").alias("total_wins"),
            F.sum("losses").alias("total_losses"),
        )
    )
    return rank_by_score(cut_lineage(totals), "total_wins", "dense")


def country_leaderboard(tables) -> DataFrame:
    """The standings once more, under the name of the second mart."""
    return tables["tournament_standings"]


def prize_earnings(tables) -> DataFrame:
    """Teams with the best win rate of each tournament (ties kept) and the tournament's prize."""
    source = tables["int_team_match_summary"].select(
        F.col("tournament_id").alias("id"),
        F.col("team_a_id").alias("team_id"),
        "total_matches",
        F.col("wins").alias("total_wins"),
        F.col("losses").alias("total_losses"),
        ratio_pct("wins", "total_matches").alias("win_pct"),
    )
    best = W.partitionBy("id").orderBy(F.desc_nulls_last("win_pct"))
    leaders = source.withColumn("place", F.dense_rank().over(best)).filter("place = 1").drop("place")
    prizes = stg_tournaments(tables).select("id", "name", "prize_pool")
    return leaders.join(prizes, "id").select(
        "id", "name", "team_id", "prize_pool", "total_matches", "total_wins", "total_losses", "win_pct"
    )


VIEWS = {
    "stg_players": stg_players,
    "stg_teams": stg_teams,
    "stg_tournaments": stg_tournaments,
    "stg_matches": stg_matches,
    "stg_player_stats": stg_player_stats,
    "int_player_match_summary": int_player_match_summary,
    "int_team_match_summary": int_team_match_summary,
}
MARTS = {
    "player_performance": player_performance,
    "tournament_standings": tournament_standings,
    "country_leaderboard": country_leaderboard,
    "prize_earnings": prize_earnings,
}


class Models:
    """Tables plus the models built on them, each built when first asked for."""

    def __init__(self, tables):
        self._tables, self._built = tables, {}

    def __getitem__(self, name: str) -> DataFrame:
        build = VIEWS.get(name) or MARTS.get(name)
        if build is None:
            return self._tables[name]
        if name not in self._built:
            self._built[name] = build(self)
        return self._built[name]


def build_models(tables) -> dict[str, DataFrame]:
    """All models in dependency order, none of them computed yet."""
    models = Models(tables)
    return {name: models[name] for name in (*VIEWS, *MARTS)}


def write_models(tables, target: str, observed: Callable[[str, DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """All models, the marts written below ``target`` as tables; ``observed`` may count a mart's rows on their way.

    The aggregated team view feeds three marts, so it is written once as well.
    """
    models = Models(tables)
    result = {name: models[name] for name in VIEWS}
    models._built["int_team_match_summary"] = _stored(result["int_team_match_summary"], target, "int_team")
    for name in MARTS:
        mart = models[name] if observed is None else observed(name, models[name])
        models._built[name] = result[name] = _stored(mart, target, name)
    return result


def _stored(df: DataFrame, target: str, name: str) -> DataFrame:
    path = f"{target.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
