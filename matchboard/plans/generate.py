"""Synthetic tables. Every random choice is a hash of seed and row key, so a row does not depend on
partitioning and a retried task makes it again; nothing is collected and no row is made on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cluster import broadcast_if_small, fits
from ..functions import draw, draw_item, row_uuid
from ..operators.analytics import at
from ..operators.ranking import bucket_assign, zip_join, zip_with_index
from ..operators.skew import skew_join
from ..schema import TOURNAMENT_STATUSES

# The choices the generated tables draw from.
COUNTRIES = (
    "USA", "China", "South Korea", "Brazil", "Russia", "France", "Germany", "Sweden", "Denmark", "UK",
    "Canada", "Australia", "Japan", "Poland", "Turkey", "Indonesia", "Philippines", "Vietnam", "India", "Thailand",
)
BIRTH_DATES = (
    "2007-09-15", "2007-07-02", "2006-11-22", "2006-02-07", "2005-12-05", "2004-11-28", "2004-10-01", "2004-08-09",
    "2005-07-15", "2005-03-26", "2003-02-20", "2003-05-10", "2002-06-12", "2001-05-25", "2001-09-18", "2001-04-05",
    "2000-11-14", "2000-08-22", "2000-03-03", "1999-07-19", "1999-12-11", "1998-05-25", "1998-06-17", "1997-10-29",
    "1997-04-08", "1996-09-15", "1995-12-23", "1996-01-26", "1995-06-17", "1995-05-25",
)
TIME_ZONES = (
    "America/Los_Angeles", "Asia/Shanghai", "Asia/Seoul", "America/Sao_Paulo", "Europe/Moscow", "Europe/Paris",
    "Europe/Berlin", "Europe/Stockholm", "Europe/Copenhagen", "Europe/London", "America/Toronto", "Australia/Sydney",
    "Asia/Tokyo", "Europe/Warsaw", "Europe/Istanbul", "Asia/Jakarta", "Asia/Manila", "Asia/Ho_Chi_Minh",
    "Asia/Kolkata", "Asia/Bangkok",
)
REGIONS = ("North America", "South America", "Europe", "Oceania", "Asia")
GAMES = (
    "Dota 2", "League of Legends", "Counter-Strike 2", "Valorant", "Call of Duty", "Rainbow Six Siege", "Overwatch 2",
    "Fortnite", "PUBG: Battlegrounds", "Apex Legends", "Rocket League", "FIFA (EA FC)", "NBA 2K", "Street Fighter 6",
    "Tekken 8", "Super Smash Bros. Ultimate", "Mortal Kombat 1", "StarCraft II", "Hearthstone", "Teamfight Tactics",
)
ROLES = ("IGL", "AWPer", "Support", "Entry Fragger", "Lurker")
PLAYERS_PER_TEAM = 6
PLAYERS_PER_MATCH = 8
LEAST_MATCHES = 10
BLOCK_BITS, BROADCAST_IDS = 10, 1 << 23
BAN_REASON = "Violation of terms of service"
FIRST_DAY = "2001-10-10"


def series(spark: SparkSession, first: int, last: int, name: str = "n") -> DataFrame:
    """The numbers first..last, made inside the tasks."""
    return spark.range(first, last + 1).withColumnRenamed("id", name)


def _below(limit: int | Column, seed: str, *key) -> Column:
    limit = F.lit(limit) if isinstance(limit, int) else limit
    return F.floor(draw(seed, *key) * limit).cast("long")


def _money(low: int, span: int, seed: str, key: str) -> Column:
    return (F.lit(low) + F.round(draw(seed, key) * span, 2)).cast("decimal(15,2)")


def _seconds_before(as_of: str, span: int, seed: str, *key) -> Column:
    return at(as_of) - F.make_dt_interval(secs=_below(span, seed, *key).cast("decimal(18,6)"))


def gen_players(numbers: DataFrame, as_of: str) -> DataFrame:
    """One player per number ``n``: rating from 1080 up, the spread growing with n as far as 500."""
    zone = draw_item(TIME_ZONES, "player_zone", "n")
    moment = _seconds_before(as_of, 3 * 365 * 86400, "player_created", "n")
    return numbers.select(
        row_uuid("player", "n").alias("id"),
        F.concat(F.lit("player"), F.col("n").cast("string")).alias("username"),
        draw_item(COUNTRIES, "player_country", "n").alias("country"),
        draw_item(BIRTH_DATES, "player_born", "n").cast("date").alias("date_of_birth"),
        (F.lit(1080) + _below(F.least(F.col("n"), F.lit(500)), "player_elo", "n")).cast("int").alias("elo_rating"),
        F.convert_timezone(F.lit("UTC"), zone, moment).alias("created_at"),
    )


def gen_teams(numbers: DataFrame) -> DataFrame:
    """One team per number: region, founding day within a year, prize pool 50k to 100k."""
    return numbers.select(
        row_uuid("team", "n").alias("id"),
        F.concat(F.lit("team"), F.col("n").cast("string")).alias("name"),
        draw_item(REGIONS, "team_region", "n").alias("region"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), _below(365, "team_founded", "n").cast("int")).alias("founded_at"),
        _money(50_000, 50_000, "team_prize", "n").alias("prize_pool"),
        (draw("team_active", "n") < 0.5).alias("is_active"),
    )


def gen_tournaments(numbers: DataFrame) -> DataFrame:
    """One tournament per number: game, prize pool 50k to 550k, start within 2026, status."""
    start = F.make_dt_interval(secs=_below(365 * 86400, "tournament_start", "n").cast("decimal(18,6)"))
    return numbers.select(
        row_uuid("tournament", "n").alias("id"),
        F.concat(F.lit("tournament"), F.col("n").cast("string")).alias("name"),
        draw_item(GAMES, "tournament_game", "n").alias("game"),
        _money(50_000, 500_000, "tournament_prize", "n").alias("prize_pool"),
        (at("2026-01-01 00:00:00") + start).alias("starts_at"),
        draw_item(TOURNAMENT_STATUSES, "tournament_status", "n").alias("status"),
    )


def permutation(df: DataFrame, seed: str, key: str = "id", name: str = "rn") -> DataFrame:
    """Number the rows in a shuffled order."""
    return zip_with_index(df, [draw(seed, key), F.col(key)], name)


def gen_rosters(players: DataFrame, teams: DataFrame) -> DataFrame:
    """Six players per team in player order, teams in shuffled order; players left over have no team."""
    shuffled = teams.select(F.col("id").alias("team_id"))
    placed = bucket_assign(
        players.select(F.col("id").alias("player_id")),
        shuffled,
        PLAYERS_PER_TEAM,
        [F.asc("player_id")],
        [draw("roster_team", "team_id"), F.col("team_id")],
    )
    pick = F.round(draw("roster_role", "player_id") * (len(ROLES) - 1)).cast("int")  # the end roles are half as likely
    joined_at = F.date_add(F.lit(FIRST_DAY).cast("date"), _below(365, "roster_joined", "player_id").cast("int"))
    return placed.select(
        F.col("member_rn").alias("id"),
        "team_id",
        "player_id",
        F.element_at(F.array(*[F.lit(r) for r in ROLES]), pick + 1).alias("role"),
        joined_at.alias("joined_at"),
        F.date_add(joined_at, 2).alias("left_at"),
    )


def _by_position(df: DataFrame, name: str) -> DataFrame:
    """Ids with their position from 0, to be drawn by number; broadcast if few."""
    ids = df.select(F.col("id").alias(name))
    return broadcast_if_small(zip_with_index(ids, [F.asc(name)], f"{name}_at", start=0))


def gen_matches(
    numbers: DataFrame, tournaments: DataFrame, teams: DataFrame, as_of: str, upcoming: bool = False
) -> DataFrame:
    """One match per number between two different teams; the higher of two scores 5..16 wins, a draw
    is broken by a further point. ``upcoming`` gives the variant with a fair winner and later dates."""
    n_teams, n_tournaments = teams.count(), tournaments.count()
    if n_teams < 2 or n_tournaments < 1:
        raise ValueError("matches need two teams and a tournament")
    a = _below(n_teams, "match_a", "n")
    b = (a + 1 + _below(n_teams - 1, "match_b", "n")) % n_teams  # never the same team
    score_a = 5 + F.round(draw("match_score_a", "n") * 11)
    score_b = 5 + F.round(draw("match_score_b", "n") * 11)
    coin = draw("match_coin", "n") < 0.5
    if upcoming:
        a_wins = coin
        played_at = at(as_of) + F.make_dt_interval(secs=_below(365 * 86400, "match_time", "n").cast("decimal(18,6)"))
    else:
        a_wins = F.when(score_a == score_b, coin).otherwise(score_a > score_b)
        played_at = _seconds_before(as_of, 730 * 86400, "match_time", "n")
    drawn = numbers.select(
        row_uuid("match", "n").alias("id"),
        _below(n_tournaments, "match_tournament", "n").alias("tournament_id_at"),
        a.alias("team_a_id_at"),
        b.alias("team_b_id_at"),
        a_wins.alias("a_wins"),
        played_at.alias("played_at"),
    )
    # draws are even, so no position is hot
    for frame, name in ((tournaments, "tournament_id"), (teams, "team_a_id"), (teams, "team_b_id")):
        drawn = drawn.join(_by_position(frame, name), f"{name}_at")
    winner = F.when(F.col("a_wins"), F.col("team_a_id")).otherwise(F.col("team_b_id"))
    return drawn.select("id", "tournament_id", "team_a_id", "team_b_id", winner.alias("winner_id"), "played_at")


def _different(n: int, picks: int, seed: str, *key) -> Column:
    """``picks`` different numbers below ``n``, every set of them as likely, as an array.

    The k-th number is drawn below n - picks + k; one that was drawn before gives way to the largest of that range,
    which cannot have been. So no list of all numbers is needed, and no draw is repeated.
    """

    def pick(chosen: Column, drawn: Column) -> Column:
        return F.array_append(chosen, F.when(F.array_contains(chosen, drawn), n - picks + F.size(chosen)).otherwise(drawn))

    drawn = F.array(*[_below(n - picks + k, seed, *key, F.lit(k)) for k in range(1, picks + 1)])
    return F.aggregate(drawn, F.array().cast("array<bigint>"), pick)


def _with_id_at(rows: DataFrame, df: DataFrame, name: str) -> DataFrame:
    """Rows with the id of ``df`` at the position ``{name}_at``, counted from 0.

    Positions have no gaps, so ids are broadcast in blocks, eight bytes an id: 64 MB at most. More are shuffled.
    """
    at = f"{name}_at"
    ids = zip_with_index(df.select(F.col("id").alias(name)), [F.asc(name)], at, start=0)
    if not fits(ids, BROADCAST_IDS):
        return rows.join(ids, at)
    block = F.shiftright(at, BLOCK_BITS)
    blocks = ids.groupBy(block.alias("__block")).agg(F.sort_array(F.collect_list(F.struct(at, name))).getField(name).alias("__ids"))
    found = rows.withColumn("__block", block).join(F.broadcast(blocks), "__block")
    in_block = F.col(at).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")
    return found.withColumn(name, F.get("__ids", in_block)).drop("__block", "__ids")


def gen_player_stats(matches: DataFrame, players: DataFrame, wide: bool = False, groups: int = 1) -> DataFrame:
    """Eight different players per match, any eight as likely. ``wide`` gives the variant with deaths from 0, ids
    without gaps and ``groups`` times eight players per match."""
    n_players = players.count()
    if n_players < PLAYERS_PER_MATCH:
        raise ValueError(f"need at least {PLAYERS_PER_MATCH} players")
    if wide and fits(matches, LEAST_MATCHES - 1):
        raise ValueError(f"need at least {LEAST_MATCHES} matches")
    numbered = zip_with_index(matches.select(F.col("id").alias("match_id")), [F.asc("match_id")], "i")
    tasks = int(matches.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, but much to make of them
    spread = numbered.repartition(tasks, "i")
    grouped = spread.select("*", F.explode(F.sequence(F.lit(1), F.lit(groups))).alias("g"))
    chosen = _different(n_players, PLAYERS_PER_MATCH, "stat_player", "match_id", "g")
    rows = grouped.select("*", F.posexplode(chosen).alias("place", "player_id_at")).withColumn("s", F.col("place") + 1)
    kills, deaths, assists = (40, 25, 20) if wide else (40, 20, 15)
    least = 0 if wide else 1
    damage, headshots = ((100, 4500), (25, 55)) if wide else ((1, 3000), (30, 40))
    in_order = ((F.col("i") - 1) * groups + F.col("g") - 1) * PLAYERS_PER_MATCH + F.col("s")

    def count(limit: int, seed: str) -> Column:
        return (_below(limit, seed, "key") + least).cast("int")

    def number(bounds: tuple[int, int], seed: str, digits: int) -> Column:
        return F.round(draw(seed, "key") * bounds[1] + bounds[0], 2).cast(f"decimal({digits},2)")

    found = _with_id_at(rows, players, "player_id")
    return found.select("*", F.concat_ws(":", "match_id", "g", "s").alias("key")).select(  # put together once
        (in_order if wide else F.col("i") * 10 + F.col("s")).alias("id"),
        "match_id",
        "player_id",
        count(kills, "stat_kills").alias("kills"),
        count(deaths, "stat_deaths").alias("deaths"),
        count(assists, "stat_assists").alias("assists"),
        number(damage, "stat_damage", 12).alias("damage_dealt"),
        number(headshots, "stat_headshot", 5).alias("headshot_pct"),
    )


def gen_elo_history(stats: DataFrame, players: DataFrame, as_of: str) -> DataFrame:
    """One rating change per statistics row: 1200 plus or minus up to 499, within the last year."""
    numbered = zip_with_index(stats.select("player_id", "match_id"), [F.asc("player_id"), F.asc("match_id")], "id")
    step = _below(500, "elo_step", "id")
    after = F.when(draw("elo_side", "id") < 0.5, 1200 - step).otherwise(1200 + step)
    rated = players.select(F.col("id").alias("player_id"), F.col("elo_rating").alias("elo_before"))
    return skew_join(numbered, rated, ["player_id"]).select(
        "id",
        "player_id",
        "match_id",
        "elo_before",
        after.cast("int").alias("elo_after"),
        _seconds_before(as_of, 365 * 86400, "elo_time", "id").alias("changed_at"),
    )


def gen_bans(players: DataFrame, as_of: str, share: float = 0.1) -> DataFrame:
    """About a tenth of the players, banned a week ago for 37 days, numbered from 1."""
    banned = players.filter(draw("ban", "id") < share).select(F.col("id").alias("player_id"))
    return zip_with_index(banned, [F.asc("player_id")], "id").select(
        "id",
        "player_id",
        F.lit(BAN_REASON).alias("reason"),
        (at(as_of) - F.make_dt_interval(F.lit(7))).alias("banned_at"),
        (at(as_of) + F.make_dt_interval(F.lit(30))).alias("expires_at"),
        F.lit(False).alias("is_permanent"),
    )


def gen_payouts(players: DataFrame, teams: DataFrame, tournaments: DataFrame, as_of: str) -> DataFrame:
    """The i-th player, the i-th team and the i-th tournament (the latter two shuffled) share a payout."""
    frames = [
        players.select(F.col("id").alias("player_id")),
        teams.select(F.col("id").alias("team_id")),
        tournaments.select(F.col("id").alias("tournament_id")),
    ]
    orders = [
        [F.asc("player_id")],
        [draw("payout_team", "team_id"), F.col("team_id")],
        [draw("payout_tournament", "tournament_id"), F.col("tournament_id")],
    ]
    return zip_join(frames, orders, "id").select(
        "id",
        "tournament_id",
        "team_id",
        "player_id",
        (F.lit(50_000) + _below(50_000, "payout_amount", "id")).cast("decimal(12,2)").alias("amount"),
        _seconds_before(as_of, 365 * 86400, "payout_time", "id").alias("paid_at"),
    )
