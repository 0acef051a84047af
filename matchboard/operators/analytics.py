"""The analytical queries over matches, statistics, ratings and payouts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..cluster import cut_lineage, fits
from ..functions import kda_ratio, ratio_pct, streakcount
from .ranking import rank_by_score, rank_top, top_k, top_n_per_key
from .skew import (
    HOT_ROWS,
    SEGMENT,
    SEGMENT_ROWS,
    HotGroup,
    add_offsets,
    add_segment,
    hot_groups,
    only_hot,
    position_in_group,
    skew_join,
    without_hot,
)

MAX_LEADERBOARD = 500  # fixed value: the largest leaderboard that may be asked for
FEW_GROUPS = 200_000
_REPEAT_STEP = 10_000
_TEAM = ["tournament_id", "team_a_id"]


def at(moment: str | datetime) -> Column:
    """Zone-free timestamp literal."""
    return F.lit(str(moment)).cast("timestamp_ntz")


def top_kda(stats: DataFrame, k: int = 10) -> DataFrame:
    """Best single-match KDA values; rows without deaths have none and come last."""
    scored = stats.select("player_id", kda_ratio("kills", "assists", "deaths").alias("kda"))
    return top_k(scored, [F.desc_nulls_last("kda"), F.asc("player_id")], k)


def win_rate(matches: DataFrame, limit: int | None = None) -> DataFrame:
    """Share of a team's matches as first team that it won, per tournament."""
    rates = matches.groupBy("tournament_id", "team_a_id").agg(
        ratio_pct(F.count_if(F.col("team_a_id") == F.col("winner_id")), F.count("team_a_id")).alias("winrate")
    )
    order = [F.asc_nulls_last("tournament_id"), F.asc_nulls_last("team_a_id")]
    return rates.orderBy(*order) if limit is None else top_k(rates, order, limit)


def frequent_pairs(matches: DataFrame, more_than: int = 3) -> DataFrame:
    """(tournament, first team) groups with more than ``more_than`` matches."""
    counted = matches.groupBy("tournament_id", "team_a_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") > more_than).drop("n")


def prize_by_player(payouts: DataFrame, limit: int | None = None) -> DataFrame:
    """Total payouts per player; with ``limit`` the players who earned most."""
    totals = payouts.groupBy("player_id").agg(F.sum("amount").cast("double").alias("total_amount"))
    return totals if limit is None else top_k(totals, [F.desc_nulls_last("total_amount"), F.asc("player_id")], limit)


def _repeat(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as its count says, in two steps so that no list of copies gets long."""
    size = F.lit(_REPEAT_STEP).cast("long")
    steps = F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col(times) - 1, size))
    stepped = df.withColumn("__step", F.explode(steps))
    left = F.least(size, F.col(times) - F.col("__step") * size)
    return stepped.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), left))).drop("__step", "__copy")


def avg_damage(
    stats: DataFrame, hot: Sequence[HotGroup] | None = None, rows_per_segment: int = SEGMENT_ROWS
) -> DataFrame:
    """Average damage in a match over all players up to the row's player, rows of one player together.

    An ordinary match is one window partition. A hot match is added up per player first, cut into
    ranges of players, and each range starts from the totals of the ranges before it.
    """
    hot = hot_groups(stats, ["match_id"]) if hot is None else hot
    rows = stats.select("match_id", "player_id", "damage_dealt")
    upto = W.partitionBy("match_id").orderBy(F.asc_nulls_last("player_id"))
    ordinary = without_hot(rows, ["match_id"], hot)
    mean = F.sum("damage_dealt").over(upto).cast("double") / F.nullif(F.count("damage_dealt").over(upto), F.lit(0))
    result = ordinary.select("match_id", "player_id", mean.alias("avg_dmg"))
    if not hot:
        return result
    players = (
        only_hot(rows, ["match_id"], hot)
        .groupBy("match_id", "player_id")
        .agg(F.sum("damage_dealt").alias("s"), F.count("damage_dealt").alias("c"), F.count(F.lit(1)).alias("n"))
    )
    cut = add_segment(players, ["match_id"], ["player_id"], hot, rows_per_segment)
    total = add_offsets(cut, ["match_id"], {"s0": F.sum("s"), "c0": F.sum("c")}, hot)
    within = W.partitionBy("match_id", SEGMENT).orderBy(F.asc_nulls_last("player_id"))
    means = total.select(
        "match_id",
        "player_id",
        "n",
        (
            (F.coalesce(F.sum("s").over(within), F.lit(0)) + F.col("s0")).cast("double")
            / F.nullif(F.sum("c").over(within) + F.col("c0"), F.lit(0))
        ).alias("avg_dmg"),
    )
    return result.unionByName(_repeat(means, "n").drop("n"))


def elo_delta(history: DataFrame) -> DataFrame:
    """Rating change of every history row."""
    return history.select(
        "id", "player_id", "match_id", (F.col("elo_after") - F.col("elo_before")).cast("long").alias("elo_delta")
    )


def elo_last_days(history: DataFrame, as_of: str, days: int = 30, open_ended: bool = False) -> DataFrame:
    """Rating changes in the ``days`` before ``as_of``; ``open_ended`` keeps later rows too."""
    changed = F.col("changed_at")
    recent = history.filter(changed >= at(as_of) - F.make_dt_interval(F.lit(days)))
    if not open_ended:
        recent = recent.filter(changed < at(as_of))
    return recent.select("player_id", (F.col("elo_after") - F.col("elo_before")).cast("long").alias("elo_delta"))


def most_improved(history: DataFrame, as_of: str, days: int = 30, k: int = 1) -> DataFrame:
    """The ``k`` largest recent rating changes with their dense rank."""
    recent = elo_last_days(history, as_of, days)
    return rank_top(recent, "elo_delta", k, "dense", [F.asc("player_id")], "dense_rank")


def top_players(players: DataFrame, n: int) -> DataFrame:
    """All columns of the ``n`` highest rated players."""
    return top_k(players, [F.desc_nulls_last("elo_rating"), F.asc("id")], n)


def top_players_ranked(players: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` highest rated players with their dense rank."""
    return rank_top(players, "elo_rating", n, "dense", [F.asc("id")], "dense_rank")


def last_n_per_player(stats: DataFrame, n: int = 10, limit: int | None = None) -> DataFrame:
    """Each player's rows for their ``n`` latest matches; the remaining columns break ties."""
    rest = [F.desc_nulls_last(c) for c in stats.columns if c not in ("player_id", "match_id")]
    latest = top_n_per_key(stats, ["player_id"], [F.desc_nulls_last("match_id"), *rest], n, "rnk")
    return latest if limit is None else top_k(latest, [F.asc("player_id"), F.asc("match_id"), F.asc("rnk")], limit)


def leaderboard(players: DataFrame, limit: int = 100, kind: str = "rank") -> DataFrame:
    """Global leaderboard. ``rank`` gives equal ratings the same place, ``positional`` counts 1, 2, 3."""
    if not 1 <= limit <= MAX_LEADERBOARD:
        raise ValueError(f"limit must be between 1 and {MAX_LEADERBOARD}, got {limit}")
    shown = [F.col("id").cast("string").alias("player_id"), "username", "country", F.col("elo_rating").cast("long")]
    if kind == "rank":
        best = rank_top(players, "elo_rating", limit, "rank", [F.asc("id")])
    else:  # the scored set lists equal scores by descending member
        best = top_k(players, [F.desc_nulls_last("elo_rating"), F.desc(F.col("id").cast("string"))], limit)
        order = W.orderBy(F.desc_nulls_last("elo_rating"), F.desc(F.col("id").cast("string")))  # at most limit rows
        best = best.withColumn("rank", F.row_number().over(order).cast("long"))
    return best.select("rank", *shown)


def enrich_ranked(ranked: DataFrame, metadata: DataFrame) -> DataFrame:
    """Add user name and country to ranked ids; an id without metadata is shown as ``unknown``."""
    named = metadata.select(F.col("id").cast("string").alias("player_id"), "username", "country")
    joined = ranked.join(named, "player_id", "left")  # one row per id on both sides
    return joined.select(
        "rank", "player_id", F.coalesce("username", F.lit("unknown")).alias("username"), "elo_rating", "country"
    )


def lookup(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is in a set of ids (a batch of point lookups)."""
    wanted = ids.select(F.col(ids.columns[0]).alias(key)).distinct()
    return df.join(wanted, key, "left_semi")  # one row per key on both sides


def win_flags(matches: DataFrame) -> DataFrame:
    """Per match, 1 when the first team won, else 0."""
    won = F.when(F.col("team_a_id") == F.col("winner_id"), F.lit("1")).otherwise(F.lit("0"))
    return matches.select(F.col("id").alias("match_id"), "tournament_id", "team_a_id", won.alias("streak"))


def win_history(matches: DataFrame, hot: Sequence[HotGroup] | None = None) -> DataFrame:
    """Win flag of every match with its place, 1, 2, ..., in the playing order of its (tournament, first team)."""
    flags = matches.select(
        *_TEAM, "played_at", "id", F.when(F.col("team_a_id") == F.col("winner_id"), "1").otherwise("0").alias("streak")
    )
    placed = position_in_group(flags, _TEAM, ["played_at", "id"], "place", hot)
    return placed.select(*_TEAM, "place", F.col("id").alias("match_id"), "streak")


def streak_from_history(
    matches: DataFrame,
    rows_per_text: int = 10_000,
    hot: Sequence[HotGroup] | None = None,
    run_length: Callable[[Column], Column] = streakcount,
) -> DataFrame:
    """Current streak per (tournament, first team), read from histories written as text with ``run_length``.

    A history is written in texts of ``rows_per_text`` flags, so that none outgrows a task. The streak of the
    group is the run that ends its last text with a 0 in it, and all flags of the texts after that one.
    """
    text = F.call_function("div", F.col("place") - 1, F.lit(rows_per_text).cast("long")).alias("text")
    listed = F.array_sort(F.collect_list(F.struct("place", "streak")))  # at most rows_per_text entries
    texts = (
        win_history(matches, hot)
        .groupBy(*_TEAM, text)
        .agg(listed.alias("l"))
        .select(
            *_TEAM,
            "text",
            F.size("l").cast("long").alias("n"),
            run_length(F.array_join(F.col("l.streak"), ", ")).cast("long").alias("run"),
        )
    )
    ended = F.col("run") < F.col("n")
    last = texts.groupBy(*_TEAM).agg(
        F.max(F.when(ended, F.struct("text", "run"))).alias("stop"),
        F.sum("n").alias("n_all"),
        F.max("text").alias("last_text"),
    )
    # all texts but the last are full, which gives the flags after a text without counting them again
    after = F.col("n_all") - (F.col("stop.text") + 1) * rows_per_text
    streak = F.when(F.col("stop").isNull(), F.col("n_all")).otherwise(
        F.col("stop.run") + F.when(F.col("stop.text") < F.col("last_text"), after).otherwise(0)
    )
    return last.select(*_TEAM, streak.cast("long").alias("streak"))


def team_summary(matches: DataFrame, min_rows: int = HOT_ROWS) -> DataFrame:
    """Matches, wins, losses and current streak per (tournament, first team).

    The streak is the number of matches won after the last one not won, by (played_at, id). So a first
    aggregate finds that match per group, and a second counts the wins after it: no window and no sort
    of all matches of a team. The groups are written once and broadcast to the matches if few. Matches
    without tournament or team belong to no group.
    """
    keys = ["tournament_id", "team_a_id"]
    matches = matches.dropna(subset=keys)
    won = F.col("team_a_id") == F.col("winner_id")
    moment = F.struct("played_at", "id")
    groups = cut_lineage(
        matches.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("total_matches"),
            F.count_if(won).alias("wins"),
            F.count_if(~won).alias("losses"),
            F.max(F.when(~F.coalesce(won, F.lit(False)), moment)).alias("stop"),
        )
    )
    wins = matches.filter(won).select(*keys, moment.alias("moment"))
    stops = groups.filter(F.col("stop").isNotNull()).select(*keys, "stop")
    few = fits(groups, FEW_GROUPS)
    compared = wins.join(F.broadcast(stops), keys) if few else skew_join(wins, stops, keys, "inner", min_rows, 0)
    runs = compared.filter("moment > stop").groupBy(*keys).agg(F.count(F.lit(1)).alias("run"))
    runs = F.broadcast(runs) if few else runs  # no more rows than groups
    streak = F.when(F.col("stop").isNull(), F.col("total_matches")).otherwise(F.coalesce("run", F.lit(0)))
    return groups.join(runs, keys, "left").select(
        *keys, "total_matches", "wins", "losses", streak.cast("long").alias("current_streak")
    )


def current_streak(matches: DataFrame) -> DataFrame:
    """Matches won in a row up to now per (tournament, first team)."""
    return team_summary(matches).select("tournament_id", "team_a_id", "current_streak")


def team_counters(matches: DataFrame) -> DataFrame:
    """Matches played (on either side) and won per team; a match counts once per team, an open side not at all."""
    teams = F.array_compact(F.array_distinct(F.array("team_a_id", "team_b_id")))
    sides = matches.select(F.explode(teams).alias("team_id"), "winner_id")
    return sides.groupBy("team_id").agg(
        F.count(F.lit(1)).alias("matches_played"),
        F.count_if(F.col("team_id") == F.col("winner_id")).alias("matches_won"),
    )


def slow_queries(runs: DataFrame, k: int | None = None) -> DataFrame:
    """Calls, mean and total time per query name, slowest mean first. One row per name before ranking."""
    stats = runs.groupBy(F.substring("query_name", 1, 180).alias("query_name")).agg(
        F.count(F.lit(1)).alias("calls"),
        (F.sum("duration_us").cast("double") / F.count("duration_us")).alias("mean_us"),
        F.sum("duration_us").cast("long").alias("total_us"),
    )
    if k is not None:
        return rank_top(stats, "mean_us", k, "rank", [F.asc("query_name")])
    return rank_by_score(cut_lineage(stats), "mean_us", "rank")


def cache_stats(df: DataFrame) -> DataFrame:
    """Row count of a result and its size as JSON text, in characters."""
    size = F.length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    return df.select(size.alias("n")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("json_chars"),
    )
