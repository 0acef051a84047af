"""The same results stated as plain SQL over the same tables, to check the queries against."""

from __future__ import annotations

from .catalog import CREATORS, RATE, RUN_DATE
from .plans import generate as G
from .schema import FOREIGN_KEYS, TOURNAMENT_STATUSES
from .sources.fixtures import AS_OF, EVENTS_AS_OF, MATCH_TABLES, WATERMARK, view_sql

ORACLE: dict[str, str] = {}

_NOW = f"TIMESTAMP '{AS_OF}'"
_EVENTS_NOW = f"TIMESTAMP '{EVENTS_AS_OF}'"
_SINCE = f"TIMESTAMP '{WATERMARK}'"


def sql(views: str, body: str, recursive: bool = False) -> str:
    """A statement with the named views in front; ``body`` may start with further WITH clauses after ``+``."""
    names = views.split()
    clauses = view_sql(*names) if names else ""
    body = body.strip()
    if body.startswith("+"):
        body = body[1:].strip()
        clauses = f"{clauses},\n{body}" if clauses else body
        head = clauses
    else:
        head = f"{clauses}\n{body}" if clauses else body
    if not clauses:
        return head
    return f"WITH {'RECURSIVE ' if recursive else ''}{head}"


def add(name: str, views: str, body: str, recursive: bool = False) -> None:
    ORACLE[name] = sql(views, body, recursive)


def _draw(seed: str, *key: str) -> str:
    text = " || ':' || ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in key]])
    return f"(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496.0)"


def _uuid(seed: str, key: str) -> str:
    digest = f"md5('{seed}:' || {key})"
    return " || '-' || ".join(f"substr({digest}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


def _below(limit, seed: str, *key: str) -> str:
    return f"CAST(floor({_draw(seed, *key)} * {limit}) AS BIGINT)"


def _item(items, seed: str, *key: str) -> str:
    values = ", ".join(f"'{i}'" for i in items)
    return f"([{values}])[CAST(floor({_draw(seed, *key)} * {len(items)}) AS BIGINT) + 1]"


def _ago(moment: str, span: int, seed: str, *key: str) -> str:
    return f"{moment} - INTERVAL 1 SECOND * {_below(span, seed, *key)}"


# scans and sources
add("scan_players", "players", "SELECT * FROM players")
_HALF_OPEN = f"played_at > {_SINCE} AND played_at <= {_NOW}"
add("incr_matches_halfopen", "matches", f"SELECT * FROM matches WHERE {_HALF_OPEN}")
add("incr_matches_closed", "matches", f"SELECT * FROM matches WHERE played_at BETWEEN {_SINCE} AND {_NOW}")
_REGISTRY = "SELECT event_id AS id, ts AS point_of_time FROM events"
add("watermark_state", "", f"SELECT point_of_time FROM ({_REGISTRY}) ORDER BY id DESC LIMIT 1")
add(
    "watermark_advance",
    "matches",
    f"""{'+'} registry AS ({_REGISTRY})
    SELECT id, point_of_time FROM registry
    UNION ALL
    SELECT (SELECT max(id) + 1 FROM registry), max(played_at) FROM matches WHERE {_HALF_OPEN}""",
)
add("json_roundtrip", "players", "SELECT * FROM players")
add("json_records", "players", "SELECT id, username, country, elo_rating FROM players")
add("json_extract", "", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
_CREATED_BY = _item(CREATORS, "created_by", "id")
add(
    "csv_schema_drift",
    "matches",
    f"SELECT *, CASE WHEN played_at >= {_SINCE} THEN {_CREATED_BY} END AS created_by FROM matches",
)
add("gen_series", "", "SELECT unnest(range(1, (SELECT max(o_orderkey) + 2 FROM orders)))::BIGINT AS n")

# staging, intermediate and mart models
_KDA100 = """((200 * (coalesce(kills, 0) + coalesce(assists, 0)) + coalesce(deaths, 0))
             // (2 * nullif(coalesce(deaths, 0), 0)))"""
_GROUPS = """t AS (
      SELECT tournament_id, team_a_id, winner_id = team_a_id AS w,
             row_number() OVER (PARTITION BY tournament_id, team_a_id ORDER BY played_at DESC, id DESC) AS rn
      FROM matches),
    summary AS (
      SELECT tournament_id, team_a_id, count(*) AS total_matches, count(*) FILTER (WHERE w) AS wins,
             count(*) FILTER (WHERE NOT w) AS losses,
             coalesce(min(rn) FILTER (WHERE NOT w) - 1, count(*))::BIGINT AS current_streak
      FROM t GROUP BY ALL)"""
_STREAK = f"""{_GROUPS},
    team AS (SELECT * FROM summary WHERE tournament_id IN (SELECT id FROM tournaments))"""
add("stg_players", "players", "SELECT * FROM players")
add("stg_teams", "teams", "SELECT id, name, region, prize_pool::DOUBLE AS prize_pool FROM teams")
add(
    "stg_tournaments",
    "tournaments",
    "SELECT id, name, game, prize_pool::DOUBLE AS prize_pool, starts_at, status FROM tournaments",
)
add("stg_matches", "matches", "SELECT id AS match_id, * EXCLUDE (id) FROM matches")
add(
    "stg_player_stats",
    "player_stats",
    f"""SELECT id AS stat_id, match_id, player_id, kills, deaths, assists, damage_dealt::DOUBLE AS damage_dealt,
        headshot_pct::DOUBLE AS headshot_pct, {_KDA100}::DOUBLE / 100 AS kda FROM player_stats""",
)
add(
    "int_player_match_summary",
    "player_stats matches players",
    f"""SELECT s.id AS stat_id, match_id, player_id, username, country, elo_rating, tournament_id, played_at,
        kills, deaths, assists, {_KDA100}::DOUBLE / 100 AS kda, kills + assists AS total_contribution
        FROM player_stats s JOIN matches m ON m.id = match_id JOIN players p ON p.id = player_id""",
)
add("int_team_match_summary", "matches tournaments", f"+ {_STREAK} SELECT * FROM team")
add(
    "bounded_extract",
    "matches tournaments",
    f"+ {_STREAK} SELECT * FROM team ORDER BY tournament_id, team_a_id LIMIT 1000",
)
_CAREER = f"""career AS (
      SELECT player_id, username, country, elo_rating, count(*) AS total_matches, sum(kills)::BIGINT AS total_kills,
             ((200 * sum(kills) + count(kills)) // (2 * count(kills)))::DOUBLE / 100 AS avg_kills,
             ((2 * sum({_KDA100}) + count({_KDA100})) // (2 * count({_KDA100})))::DOUBLE / 100 AS career_kda
      FROM player_stats s JOIN matches m ON m.id = match_id JOIN players p ON p.id = player_id
      GROUP BY player_id, username, country, elo_rating HAVING count(*) >= 3)"""
add(
    "player_performance",
    "player_stats matches players",
    f"+ {_CAREER} SELECT *, rank() OVER (ORDER BY elo_rating DESC)::BIGINT AS global_rank FROM career",
)
_STANDINGS = f"""{_STREAK},
    standings AS (
      SELECT team_a_id AS team_id, sum(total_matches)::BIGINT AS total_matches, sum(wins)::BIGINT AS total_wins,
             sum(losses)::BIGINT AS total_losses FROM team GROUP BY team_a_id)"""
for _name in ("tournament_standings", "country_leaderboard"):
    add(
        _name,
        "matches tournaments",
        f"+ {_STANDINGS} SELECT *, dense_rank() OVER (ORDER BY total_wins DESC)::BIGINT AS rank FROM standings",
    )
_PRIZES = f"""{_STREAK},
    rated AS (
      SELECT *, ((20000 * wins + total_matches) // (2 * total_matches))::DOUBLE / 100 AS win_pct FROM team),
    prizes AS (
      SELECT t.id, t.name, team_a_id AS team_id, t.prize_pool::DOUBLE AS prize_pool, total_matches,
             wins AS total_wins, losses AS total_losses, win_pct
      FROM (SELECT *, dense_rank() OVER (PARTITION BY tournament_id ORDER BY win_pct DESC) AS d FROM rated) r
      JOIN tournaments t ON t.id = r.tournament_id WHERE d = 1)"""
add("prize_earnings", "matches tournaments", f"+ {_PRIZES} SELECT * FROM prizes")
add(
    "dq_singular",
    "matches tournaments",
    f"+ {_PRIZES} SELECT count(*) AS n_violations, count(*) = 0 AS passed FROM prizes WHERE prize_pool < 1200",
)

# sinks and stored results
add("export_csv_roundtrip", "matches", "SELECT * FROM matches")
add("late_matches", "matches", "SELECT * FROM matches")
add(
    "export_csv_text",
    "",
    r"""SELECT * REPLACE (
        CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '\N' WHEN 3 THEN '\\N' ELSE text END AS text)
        FROM documents""",
)
add(
    "export_parquet_roundtrip",
    "player_stats",
    "SELECT * REPLACE (damage_dealt::DOUBLE AS damage_dealt, headshot_pct::DOUBLE AS headshot_pct) FROM player_stats",
)
_Y, _M, _D = RUN_DATE.split("-")
add(
    "partition_layout",
    "matches",
    f"SELECT '{_Y}' AS year, '{_M}' AS month, '{_D}' AS day, count(*) AS n_rows FROM matches",
)
add(
    "load_new_matches",
    "matches",
    f"SELECT *, CAST(NULL AS VARCHAR) AS created_by, {_NOW} AS loaded_at FROM matches WHERE {_HALF_OPEN}",
)
add(
    "snapshot_manifest",
    " ".join(MATCH_TABLES),
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in MATCH_TABLES),
)
_WIN_RATE = """SELECT tournament_id, team_a_id,
    ((20000 * count(*) FILTER (WHERE team_a_id = winner_id) + count(team_a_id))
     // (2 * count(team_a_id)))::DOUBLE / 100 AS winrate
    FROM matches GROUP BY tournament_id, team_a_id"""
add("win_rate", "matches", _WIN_RATE)
add("cached_query_hit", "matches", _WIN_RATE)
add("win_rate_first_10", "matches", f"{_WIN_RATE} ORDER BY tournament_id, team_a_id LIMIT 10")
add(
    "cache_expired",
    "",
    f"""SELECT event_id, ts AS computed_at, 3600::BIGINT AS ttl_s, ts + INTERVAL 1 HOUR AS expires_at,
        ts + INTERVAL 1 HOUR <= {_EVENTS_NOW} AS expired FROM events""",
)
_TOP_500 = """SELECT CAST(id AS VARCHAR) AS player_id, elo_rating::BIGINT AS elo_rating, username, country
    FROM players ORDER BY elo_rating DESC, id LIMIT 500"""
add("leaderboard_snapshot", "players", _TOP_500)
add("stream_leaderboard", "players", _TOP_500)
add("top50_players", "players", "SELECT * FROM players ORDER BY elo_rating DESC, id LIMIT 50")
add("top_players_100", "players", "SELECT * FROM players ORDER BY elo_rating DESC, id LIMIT 100")
add(
    "cache_stats",
    "players",
    """SELECT count(*) AS n_rows,
       sum(length(to_json({'id': id, 'username': username, 'country': country, 'elo_rating': elo_rating})))::BIGINT
       AS json_chars FROM players""",
)

# projections, filters, updates
add(
    "elo_delta",
    "elo_history",
    "SELECT id, player_id, match_id, (elo_after - elo_before)::BIGINT AS elo_delta FROM elo_history",
)
_RECENT = f"""SELECT player_id, (elo_after - elo_before)::BIGINT AS elo_delta FROM elo_history
    WHERE changed_at >= {_NOW} - INTERVAL 30 DAY AND changed_at < {_NOW}"""
add("elo_last_30d", "elo_history", _RECENT)
add(
    "most_improved",
    "elo_history",
    f"""SELECT *, dense_rank() OVER (ORDER BY elo_delta DESC)::BIGINT AS dense_rank FROM ({_RECENT})
        ORDER BY dense_rank, player_id LIMIT 1""",
)
add(
    "win_flag",
    "matches",
    """SELECT id AS match_id, tournament_id, team_a_id,
       CASE WHEN team_a_id = winner_id THEN '1' ELSE '0' END AS streak FROM matches""",
)
add("player_lookup", "players", "SELECT * FROM players WHERE id IN (SELECT user_id FROM events)")
_NEWEST = """newest AS (
      SELECT id, arg_max(elo_rating, version) AS elo_rating FROM player_changes
      WHERE operation <> 'DELETE' GROUP BY id)"""
add(
    "apply_elo_updates",
    "players player_changes",
    f"""+ {_NEWEST} SELECT p.* REPLACE (coalesce(n.elo_rating, p.elo_rating) AS elo_rating)
        FROM players p LEFT JOIN newest n ON n.id = p.id""",
)
add(
    "unmatched_elo_updates",
    "teams player_changes",
    f"+ {_NEWEST} SELECT id, elo_rating FROM newest WHERE id NOT IN (SELECT id FROM teams)",
)
add(
    "write_through_leaderboard",
    "players player_changes",
    f"""+ {_NEWEST} SELECT CAST(p.id AS VARCHAR) AS player_id,
        coalesce(n.elo_rating, p.elo_rating)::BIGINT AS elo_rating, username, country
        FROM players p LEFT JOIN newest n ON n.id = p.id ORDER BY 2 DESC, p.id LIMIT 500""",
)
add("bulk_elo_shift", "players", "SELECT id, elo_rating + 100 AS elo_rating FROM players")
add("backfill_created_by", "matches", f"SELECT id, {_CREATED_BY} AS created_by FROM matches")
add("drop_created_by", "matches", "SELECT * FROM matches")
add(
    "validate_new_players",
    "players",
    f"""+ candidates AS (
      SELECT id, username, country, date_of_birth FROM players
      UNION ALL SELECT doc_id, text, lang, DATE '1995-01-01' FROM documents),
    judged AS (
      SELECT *, concat_ws(', ', CASE WHEN length(username) NOT BETWEEN 3 AND 50 THEN 'username_length' END,
                                CASE WHEN length(country) NOT BETWEEN 2 AND 60 THEN 'country_length' END) AS b
      FROM candidates)
    SELECT id, username, country, date_of_birth, CASE WHEN b = '' THEN 1200 END AS elo_rating,
           CASE WHEN b = '' THEN {_NOW} END AS created_at, nullif(b, '') AS broken_rules FROM judged""",
)

# scalar functions
add(
    "clean_text",
    "",
    "SELECT doc_id, text || CASE WHEN doc_id % 3 = 0 THEN chr(65533) || '(' ELSE '' END AS text FROM documents",
)
add(
    "interval_math",
    "matches",
    """SELECT id, played_at - INTERVAL 7 DAY AS week_before,
       played_at + INTERVAL 1 SECOND * (id % 86400) AS seconds_after,
       CAST(played_at AS DATE) + CAST(id % 365 AS INT) AS days_after FROM matches""",
)
add(
    "tz_convert",
    "matches",
    "SELECT id, (played_at AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Kolkata' AS played_local FROM matches",
)
add("iso_timestamps", "players", "SELECT id, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS created_at FROM players")
add(
    "size_labels",
    "",
    """WITH s AS (SELECT o_orderkey, o_orderkey * o_orderkey * o_orderkey AS b FROM orders)
    SELECT o_orderkey, CASE WHEN b < 10240 THEN b || ' bytes'
      WHEN b < 10485248 THEN (b + 512) // 1024 || ' kB'
      WHEN b < 10736893952 THEN (b + 524288) // 1048576 || ' MB'
      WHEN b < 10994579406848 THEN (b + 536870912) // 1073741824 || ' GB'
      ELSE (b + 549755813888) // 1099511627776 || ' TB' END AS size FROM s""",
)
add(
    "streakcount_sql",
    "matches",
    f"""+ {_GROUPS}
    SELECT tournament_id, team_a_id, current_streak AS streak FROM summary""",
)

# analytical queries
_TOP_KDA = """SELECT player_id, (kills + assists)::DOUBLE / nullif(deaths, 0)::DOUBLE AS kda
    FROM player_stats ORDER BY kda DESC NULLS LAST, player_id LIMIT 10"""
add("top_kda", "player_stats", _TOP_KDA)
add("top_kda_nulls_last", "player_stats", _TOP_KDA)
_AVG_DAMAGE = """SELECT match_id, player_id, CAST(sum(damage_dealt) OVER p AS DOUBLE) / count(damage_dealt) OVER p AS avg_dmg
    FROM player_stats WINDOW p AS (PARTITION BY match_id ORDER BY player_id)"""
add("avg_damage", "player_stats", _AVG_DAMAGE)
add("avg_damage_bucketed", "player_stats", _AVG_DAMAGE)
add(
    "frequent_pairs",
    "matches",
    "SELECT tournament_id, team_a_id FROM matches GROUP BY tournament_id, team_a_id HAVING count(*) > 3",
)
_PRIZE_TOTALS = "SELECT player_id, sum(amount)::DOUBLE AS total_amount FROM prize_payouts GROUP BY player_id"
add("prize_by_player", "prize_payouts", _PRIZE_TOTALS)
add("top_prize_players", "prize_payouts", f"{_PRIZE_TOTALS} ORDER BY total_amount DESC, player_id LIMIT 10")
add(
    "top10_dense_rank",
    "players",
    """SELECT *, dense_rank() OVER (ORDER BY elo_rating DESC)::BIGINT AS dense_rank FROM players
       ORDER BY elo_rating DESC, id LIMIT 10""",
)
_LAST_10 = """SELECT * FROM (
      SELECT * REPLACE (damage_dealt::DOUBLE AS damage_dealt, headshot_pct::DOUBLE AS headshot_pct),
             row_number() OVER (PARTITION BY player_id ORDER BY match_id DESC, id DESC, kills DESC, deaths DESC,
               assists DESC, damage_dealt DESC, headshot_pct DESC)::INT AS rnk FROM player_stats) WHERE rnk <= 10"""
add("last10_per_player", "player_stats", _LAST_10)
add("last10_first_rows", "player_stats", f"{_LAST_10} ORDER BY player_id, match_id, rnk LIMIT 10")
_BOARD = "CAST(id AS VARCHAR) AS player_id, username, country, elo_rating::BIGINT AS elo_rating FROM players"
add(
    "leaderboard_global",
    "players",
    f"SELECT rank() OVER (ORDER BY elo_rating DESC)::BIGINT AS rank, {_BOARD} ORDER BY elo_rating DESC, id LIMIT 100",
)
add(
    "leaderboard_positional",
    "players",
    f"""SELECT row_number() OVER (ORDER BY elo_rating DESC, CAST(id AS VARCHAR) DESC)::BIGINT AS rank, {_BOARD}
        ORDER BY rank LIMIT 500""",
)
add(
    "leaderboard_enriched",
    "players",
    """+ r AS (SELECT *, rank() OVER (ORDER BY elo_rating DESC)::BIGINT AS rank FROM players),
    known AS (SELECT * FROM players WHERE id IN (SELECT user_id FROM events))
    SELECT rank, CAST(r.id AS VARCHAR) AS player_id, coalesce(known.username, 'unknown') AS username,
           r.elo_rating::BIGINT AS elo_rating, known.country FROM r LEFT JOIN known ON known.id = r.id""",
)
add(
    "dense_rank_all",
    "players",
    "SELECT id, dense_rank() OVER (ORDER BY elo_rating DESC)::BIGINT AS rank FROM players",
)
add(
    "win_history",
    "matches",
    """SELECT tournament_id, team_a_id, id AS match_id, CASE WHEN team_a_id = winner_id THEN '1' ELSE '0' END AS streak,
       row_number() OVER (PARTITION BY tournament_id, team_a_id ORDER BY played_at, id) AS place FROM matches""",
)
add(
    "current_streak",
    "matches",
    f"+ {_GROUPS} SELECT tournament_id, team_a_id, current_streak FROM summary",
)
_COUNTERS = """SELECT team_id, count(*) AS matches_played, count(*) FILTER (WHERE team_id = winner_id) AS matches_won
    FROM (SELECT team_a_id AS team_id, winner_id FROM matches WHERE team_a_id IS NOT NULL
      UNION ALL SELECT team_b_id, winner_id FROM matches WHERE team_b_id IS NOT NULL AND team_b_id IS DISTINCT FROM team_a_id)
    GROUP BY team_id"""
add("team_counters", "matches", _COUNTERS)
add("stream_team_counters", "matches", _COUNTERS)
_SLOW = """SELECT *, rank() OVER (ORDER BY mean_us DESC)::BIGINT AS rank FROM (
      SELECT substr(query_name, 1, 180) AS query_name, count(*) AS calls,
             sum(duration_us)::DOUBLE / count(duration_us) AS mean_us, sum(duration_us)::BIGINT AS total_us
      FROM query_runs GROUP BY 1)"""
add("slow_queries", "query_runs", _SLOW)
add("slowest_three", "query_runs", f"{_SLOW} ORDER BY rank, query_name LIMIT 3")
add("run_log_summary", "query_runs", f"{_SLOW} ORDER BY rank, query_name LIMIT 5")

# numbering and joins by position
add(
    "surrogate_ids",
    "players",
    "SELECT id, username, row_number() OVER (ORDER BY username, id)::BIGINT AS rn FROM players",
)
add(
    "gen_permutation",
    "players",
    f"SELECT id, row_number() OVER (ORDER BY {_draw('permutation', 'id')}, id)::BIGINT AS rn FROM players",
)
add(
    "zip_join",
    "matches elo_history prize_payouts",
    """+ a AS (SELECT id AS match_id, played_at, row_number() OVER (ORDER BY played_at DESC, id) AS rn FROM matches),
    b AS (SELECT id AS elo_id, elo_after, row_number() OVER (ORDER BY elo_after, id) AS rn FROM elo_history),
    c AS (SELECT id AS payout_id, amount::DOUBLE AS amount, row_number() OVER (ORDER BY amount, id) AS rn
          FROM prize_payouts)
    SELECT * FROM a JOIN b USING (rn) JOIN c USING (rn)""",
)
add(
    "bucket_assign",
    "players teams",
    """+ p AS (SELECT id AS player_id, row_number() OVER (ORDER BY id) AS member_rn FROM players),
    t AS (SELECT id AS team_id, name, row_number() OVER (ORDER BY name) AS bucket_rn FROM teams)
    SELECT * FROM p JOIN t ON bucket_rn = (member_rn - 1) // 6 + 1""",
)

# network
add("team_edges", "matches", "SELECT DISTINCT team_a_id, team_b_id FROM matches")
add(
    "team_network",
    "matches",
    """+ edge AS (
      SELECT team_a_id::VARCHAR AS a, team_b_id::VARCHAR AS b, count(*) AS n FROM matches GROUP BY ALL)
    SELECT a AS teamname, b AS direction, 1 AS level, a || '->' || b AS full_path, 1::BIGINT AS n_rows FROM edge
    UNION ALL
    SELECT y.a, y.a || '->' || y.b, 2, x.a || '->' || y.a || '->' || y.b, y.n
    FROM edge x JOIN edge y ON y.a = x.b WHERE y.b <> y.a""",
)
add(
    "team_paths_k3",
    "matches",
    """+ e AS (SELECT DISTINCT team_a_id AS src, team_b_id AS dst FROM matches),
    p AS (
      SELECT src AS team_id, dst AS reached_id, 1 AS level, [src, dst] AS path FROM e WHERE src <> dst
      UNION ALL
      SELECT team_id, e.dst, level + 1, list_append(path, e.dst) FROM p JOIN e ON e.src = reached_id
      WHERE level < 3 AND NOT list_contains(path, e.dst))
    SELECT team_id, reached_id, level, array_to_string(path, '->') AS full_path FROM p""",
    recursive=True,
)
add(
    "chain_paths_k8",
    "",
    """+ e AS (SELECT c_custkey AS src, c_custkey + 1 AS dst FROM customer),
    p AS (
      SELECT src AS team_id, dst AS reached_id, 1 AS level, src || '->' || dst AS full_path FROM e
      UNION ALL
      SELECT team_id, e.dst, level + 1, full_path || '->' || e.dst FROM p JOIN e ON e.src = reached_id WHERE level < 8)
    SELECT * FROM p""",
    recursive=True,
)
_COUNTED = "SELECT team_id, reached_id, level, count(*) AS n_paths FROM p GROUP BY ALL"
add(
    "team_path_counts_k4",
    "matches",
    f"""+ e AS (SELECT DISTINCT team_a_id AS src, team_b_id AS dst FROM matches),
    p AS (
      SELECT src AS team_id, dst AS reached_id, 1 AS level, [src, dst] AS path FROM e WHERE src <> dst
      UNION ALL
      SELECT team_id, e.dst, level + 1, list_append(path, e.dst) FROM p JOIN e ON e.src = reached_id
      WHERE level < 3 AND NOT list_contains(path, e.dst))
    {_COUNTED}
    UNION ALL
    SELECT team_id, e.dst, 4, count(*) FROM p JOIN e ON e.src = reached_id
    WHERE level = 3 AND NOT list_contains(path, e.dst) GROUP BY ALL""",
    recursive=True,
)
add(
    "sparse_path_counts_k8",
    "",
    f"""+ e AS (
      SELECT c_custkey AS src, c_custkey + 1 AS dst FROM customer
      UNION SELECT c_custkey + 1, c_custkey - c_custkey % 5 FROM customer WHERE c_custkey % 5 > 1),
    p AS (
      SELECT src AS team_id, dst AS reached_id, 1 AS level, [src, dst] AS path FROM e WHERE src <> dst
      UNION ALL
      SELECT team_id, e.dst, level + 1, list_append(path, e.dst) FROM p JOIN e ON e.src = reached_id
      WHERE level < 8 AND NOT list_contains(path, e.dst))
    {_COUNTED}""",
    recursive=True,
)
add(
    "team_reach",
    "matches",
    """+ e AS (SELECT DISTINCT team_a_id AS src, team_b_id AS dst FROM matches WHERE team_a_id <> team_b_id),
    r AS (
      SELECT src AS team_id, dst AS reached_id, 1 AS hops FROM e
      UNION
      SELECT team_id, e.dst, hops + 1 FROM r JOIN e ON e.src = reached_id WHERE hops < 25 AND e.dst <> team_id)
    SELECT team_id, reached_id, min(hops) AS hops FROM r GROUP BY ALL""",
    recursive=True,
)

# data checks
_SHIFTED = """shifted AS (SELECT id, match_id, player_id, kills - 5 AS kills, deaths - 1 AS deaths,
      assists - 2 AS assists, (headshot_pct * 2)::DOUBLE AS headshot_pct FROM player_stats)"""


def _count(check: str, column: str, table: str, condition: str) -> str:
    return f"""SELECT '{check}' AS "check", '{column}' AS column_name, count(*) AS n_violations
        FROM {table} WHERE {condition}"""


_ROSTER = ("id", "team_id", "player_id", "role", "joined_at", "left_at")
add(
    "dq_not_null",
    "team_rosters",
    " UNION ALL ".join(_count("not_null", c, "team_rosters", f"{c} IS NULL") for c in _ROSTER),
)
add("dq_unique", "player_stats", "SELECT id, count(*) AS n_rows FROM player_stats GROUP BY id HAVING count(*) > 1")
_RANGES = [
    ("elo_rating", "players", "elo_rating NOT BETWEEN 0 AND 4000"),
    ("headshot_pct", "shifted", "headshot_pct NOT BETWEEN 0 AND 100"),
    ("kills", "shifted", "kills < 0"),
    ("deaths", "shifted", "deaths > 4"),
]
add(
    "dq_accepted_range",
    "players player_stats",
    f"+ {_SHIFTED} " + " UNION ALL ".join(_count("accepted_range", *r) for r in _RANGES),
)
add(
    "dq_accepted_values",
    "tournaments",
    """SELECT status AS value, count(*) AS n_rows FROM tournaments
       WHERE status NOT IN ('upcoming', 'completed', 'ongoing') GROUP BY status""",
)
_NEGATIVE = (
    f"+ {_SHIFTED} "
    + " UNION ALL ".join(
        f"""SELECT player_id, 'Negative {c} for player ' || player_id || ': ' || {c} AS message
            FROM shifted WHERE {c} < 0"""
        for c in ("kills", "assists", "deaths")
    )
)
add("dq_negative_stats", "player_stats", _NEGATIVE)
add("validation_log", "player_stats", _NEGATIVE)
add(
    "dq_composite_pk",
    "player_stats",
    "SELECT match_id, player_id, count(*) AS n_rows FROM player_stats GROUP BY ALL HAVING count(*) > 1",
)
add(
    "dq_active_roster",
    "team_rosters",
    """SELECT player_id, count(*) AS n_rows FROM team_rosters WHERE left_at IS NULL
       GROUP BY player_id HAVING count(*) > 1""",
)
add(
    "quarantine_stats",
    "player_stats",
    f"""+ {_SHIFTED}
    SELECT *, nullif(concat_ws(', ', CASE WHEN kills < 0 THEN 'kills_not_negative' END,
      CASE WHEN deaths < 0 THEN 'deaths_not_negative' END, CASE WHEN assists < 0 THEN 'assists_not_negative' END,
      CASE WHEN headshot_pct NOT BETWEEN 0 AND 100 THEN 'headshot_pct_0_100' END), '') AS broken_rules
    FROM shifted""",
)
add(
    "quarantine_split",
    "",
    f"""SELECT CASE WHEN broken_rules IS NULL THEN 'valid' ELSE 'rejected' END AS part, broken_rules, count(*) AS n_rows
    FROM ({ORACLE['quarantine_stats']}) GROUP BY ALL""",
)
add(
    "dq_utf8",
    "",
    " UNION ALL ".join(
        _count("utf8", c, "documents", "doc_id % 3 = 0 AND text IS NOT NULL" if c == "text" else "false")
        for c in ("text", "lang", "source")
    ),
)
add(
    "fk_violations",
    " ".join(sorted({c for c, _, _ in FOREIGN_KEYS} | {p for _, _, p in FOREIGN_KEYS})),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS child_table, '{col}' AS column_name, '{p}' AS parent_table, {col}::VARCHAR AS value,
            count(*) AS n_rows FROM {c} WHERE {col} NOT IN (SELECT id FROM {p}) GROUP BY {col}"""
        for c, col, p in (*FOREIGN_KEYS, ("lineitem", "l_suppkey", "teams"))
    ),
)

_TESTED = {
    "stg_players": [("id", "unique"), ("id", "not_null"), ("elo_rating", "0 AND 4000")],
    "stg_player_stats": [("stat_id", "unique"), ("stat_id", "not_null"), ("headshot_pct", "0 AND 100")],
    "stg_tournaments": [("id", "unique"), ("id", "not_null"), ("status", TOURNAMENT_STATUSES)],
    "stg_matches": [("match_id", "unique"), ("match_id", "not_null")],
    "stg_teams": [("id", "unique"), ("id", "not_null")],
    "player_performance": [("player_id", "unique"), ("player_id", "not_null"), ("career_kda", "0 AND 1e300")],
    "tournament_standings": [("team_id", "unique"), ("total_wins", "0 AND 1e300")],
    "prize_earnings": [("id", "unique"), ("prize_pool", "0 AND 1e300")],
}


def _tested(model: str, column: str, test) -> str:
    source = f"({ORACLE[model]})"
    if test == "unique":
        source = f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
        check, condition = test, "true"
    elif test == "not_null":
        check, condition = test, f"{column} IS NULL"
    elif isinstance(test, tuple):
        check, condition = "accepted_values", f"{column} NOT IN {test}"
    else:
        check, condition = "accepted_range", f"{column} NOT BETWEEN {test}"
    return f"""SELECT '{model}' AS model, '{check}' AS "check", '{column}' AS column_name,
        count(*) AS n_violations, count(*) = 0 AS passed FROM {source} WHERE {condition}"""


for _query in ("model_tests", "marts_tested"):
    add(_query, "", " UNION ALL ".join(_tested(model, *test) for model, tests in _TESTED.items() for test in tests))

# changes
add(
    "audit_diff",
    "players players_before",
    f"""+ o AS (SELECT id, {{'id': id, 'username': username, 'country': country, 'elo_rating': elo_rating}} AS j
               FROM players_before),
    n AS (SELECT id, {{'id': id, 'username': username, 'country': country, 'elo_rating': elo_rating}} AS j FROM players)
    SELECT coalesce(n.id, o.id) AS row_key, 'players' AS table_name,
           CASE WHEN o.id IS NULL THEN 'INSERT' WHEN n.id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation,
           CASE WHEN o.id IS NOT NULL THEN to_json(o.j)::VARCHAR END AS old_data,
           CASE WHEN n.id IS NOT NULL THEN to_json(n.j)::VARCHAR END AS new_data, {_NOW} AS changed_at
    FROM o FULL JOIN n ON o.id = n.id WHERE o.id IS NULL OR n.id IS NULL OR o.j IS DISTINCT FROM n.j""",
)
_FEED = """+ f AS (
      SELECT *, to_json({'id': id, 'elo_rating': elo_rating})::VARCHAR AS j FROM player_changes),
    g AS (SELECT *, lag(j) OVER (PARTITION BY id ORDER BY version) AS before FROM f)
    SELECT id AS row_key, version, 'players' AS table_name, operation,
           CASE WHEN operation <> 'INSERT' THEN before END AS old_data,
           CASE WHEN operation <> 'DELETE' THEN j END AS new_data, changed_at FROM g"""
add("audit_feed", "player_changes", _FEED)
add("audit_stream", "player_changes", _FEED)
_BLOAT = """+ v AS (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS rn FROM player_changes),
    b AS (SELECT 'players' AS table_name, count(*) FILTER (WHERE rn = 1 AND operation <> 'DELETE') AS live,
                 count(*) AS versions FROM v)"""
add(
    "changelog_bloat",
    "player_changes",
    f"""{_BLOAT} SELECT table_name, live, versions - live AS dead,
        ((20000 * (versions - live) + versions) // (2 * versions))::DOUBLE / 100 AS dead_pct
        FROM b WHERE versions - live > 0.15 * live""",
)
_COMPACT = """SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS rn FROM player_changes)
    WHERE rn = 1 AND operation <> 'DELETE'"""
add("changelog_compact", "player_changes", _COMPACT)

# rate limit and streams
_LIMIT = f"""WITH RECURSIVE s AS (
      SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
    c AS (
      SELECT user_id, event_id, rn, ts AS st, 1 AS n FROM s WHERE rn = 1
      UNION ALL
      SELECT s.user_id, s.event_id, s.rn,
             CASE WHEN s.ts >= c.st + INTERVAL {RATE['seconds']} SECOND THEN s.ts ELSE c.st END,
             CASE WHEN s.ts >= c.st + INTERVAL {RATE['seconds']} SECOND THEN 1 ELSE c.n + 1 END
      FROM s JOIN c ON s.user_id = c.user_id AND s.rn = c.rn + 1)
    SELECT user_id, event_id, n <= {RATE['max_calls']} AS allowed FROM c"""
add("rate_limit", "", _LIMIT)
add("stream_rate_limit", "", _LIMIT)
add("stream_rate_limit_state", "", _LIMIT)
add("stream_new_matches", "matches", "SELECT * FROM matches")
add("stream_dedup", "", "SELECT DISTINCT l_orderkey * 10 + l_linenumber AS id FROM lineitem")

# synthetic tables
_ZONED = f"(({_ago(_NOW, 3 * 365 * 86400, 'player_created', 'n')}) AT TIME ZONE 'UTC') AT TIME ZONE"
add(
    "gen_players",
    "",
    f"""SELECT {_uuid('player', 'n')} AS id, 'player' || n AS username,
        {_item(G.COUNTRIES, 'player_country', 'n')} AS country,
        CAST({_item(G.BIRTH_DATES, 'player_born', 'n')} AS DATE) AS date_of_birth,
        (1080 + {_below('least(n, 500)', 'player_elo', 'n')})::INT AS elo_rating,
        {_ZONED} {_item(G.TIME_ZONES, 'player_zone', 'n')} AS created_at
        FROM (SELECT c_custkey + 1 AS n FROM customer)""",
)
add(
    "gen_teams",
    "",
    f"""SELECT {_uuid('team', 'n')} AS id, 'team' || n AS name, {_item(G.REGIONS, 'team_region', 'n')} AS region,
        DATE '2001-10-10' + {_below(365, 'team_founded', 'n')}::INT AS founded_at,
        CAST(50000 + round({_draw('team_prize', 'n')} * 50000, 2) AS DECIMAL(15,2))::DOUBLE AS prize_pool,
        {_draw('team_active', 'n')} < 0.5 AS is_active
        FROM (SELECT s_suppkey + 1 AS n FROM supplier)""",
)
add(
    "gen_tournaments",
    "",
    f"""SELECT {_uuid('tournament', 'n')} AS id, 'tournament' || n AS name,
        {_item(G.GAMES, 'tournament_game', 'n')} AS game,
        CAST(50000 + round({_draw('tournament_prize', 'n')} * 500000, 2) AS DECIMAL(15,2))::DOUBLE AS prize_pool,
        TIMESTAMP '2026-01-01 00:00:00'
          + INTERVAL 1 SECOND * {_below(365 * 86400, 'tournament_start', 'n')} AS starts_at,
        {_item(TOURNAMENT_STATUSES, 'tournament_status', 'n')} AS status
        FROM (SELECT p_partkey + 1 AS n FROM part)""",
)
_JOINED = f"DATE '2001-10-10' + {_below(365, 'roster_joined', 'player_id')}::INT"
add(
    "gen_rosters",
    "players teams",
    f"""+ p AS (SELECT id AS player_id, row_number() OVER (ORDER BY id) AS rn FROM players),
    t AS (SELECT id AS team_id, row_number() OVER (ORDER BY {_draw('roster_team', 'id')}, id) AS rn FROM teams)
    SELECT p.rn AS id, team_id, player_id,
           ({list(G.ROLES)})[round({_draw('roster_role', 'player_id')} * 4)::INT + 1] AS role, {_JOINED} AS joined_at, {_JOINED} + 2 AS left_at
    FROM p JOIN t ON t.rn = (p.rn - 1) // 6 + 1""",
)


def _matches(winner: str, played_at: str) -> str:
    return f"""+ t AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS at FROM teams),
    u AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS at FROM tournaments),
    d AS (
      SELECT n, {_below('(SELECT count(*) FROM teams)', 'match_a', 'n')} AS a,
             {_below('((SELECT count(*) FROM teams) - 1)', 'match_b', 'n')} AS step,
             {_below('(SELECT count(*) FROM tournaments)', 'match_tournament', 'n')} AS tour,
             5 + round({_draw('match_score_a', 'n')} * 11) AS score_a,
             5 + round({_draw('match_score_b', 'n')} * 11) AS score_b, {_draw('match_coin', 'n')} < 0.5 AS coin
      FROM (SELECT o_orderkey + 1 AS n FROM orders))
    SELECT {_uuid('match', 'n')} AS id, u.id AS tournament_id, x.id AS team_a_id, y.id AS team_b_id,
           CASE WHEN {winner} THEN x.id ELSE y.id END AS winner_id, {played_at} AS played_at
    FROM d JOIN u ON u.at = tour JOIN t x ON x.at = a
    JOIN t y ON y.at = (a + 1 + step) % (SELECT count(*) FROM teams)"""


add(
    "gen_matches",
    "teams tournaments",
    _matches(
        "(score_a = score_b AND coin) OR score_a > score_b", _ago(_NOW, 730 * 86400, "match_time", "n")
    ),
)
add(
    "gen_upcoming_matches",
    "teams tournaments",
    _matches("coin", f"{_NOW} + INTERVAL 1 SECOND * {_below(365 * 86400, 'match_time', 'n')}"),
)


def _stats(row_id: str, groups: int, kills: int, deaths: int, assists: int, least: int, damage, headshots) -> str:
    key = ("match_id", "g", "s")
    picks = range(1, 9)
    draws = ", ".join(f"{_below(f'(n - {8 - k})', 'stat_player', 'match_id', 'g', str(k))} AS t{k}" for k in picks)
    before = {k: ", ".join(f"c{j}" for j in range(1, k)) or "-1" for k in picks}
    chosen = ", ".join(f"CASE WHEN t{k} IN ({before[k]}) THEN n - {9 - k} ELSE t{k} END AS c{k}" for k in picks)
    return f"""+ p AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS at FROM players),
    c AS (SELECT count(*) AS n FROM players),
    d AS (
      SELECT i, match_id, g, n, {draws}
      FROM (SELECT id AS match_id, row_number() OVER (ORDER BY id) AS i FROM matches),
           (SELECT unnest(range(1, {groups} + 1)) AS g), c),
    w AS (SELECT i, match_id, g, {chosen} FROM d),
    r AS (SELECT i, match_id, g, unnest(range(1, 9)) AS s, unnest([{before[8]}, c8]) AS player_at FROM w)
    SELECT {row_id} AS id, match_id, p.id AS player_id,
           ({_below(kills, 'stat_kills', *key)} + {least})::INT AS kills,
           ({_below(deaths, 'stat_deaths', *key)} + {least})::INT AS deaths,
           ({_below(assists, 'stat_assists', *key)} + {least})::INT AS assists,
           round({_draw('stat_damage', *key)} * {damage[1]} + {damage[0]}, 2) AS damage_dealt,
           round({_draw('stat_headshot', *key)} * {headshots[1]} + {headshots[0]}, 2) AS headshot_pct
    FROM r JOIN p ON p.at = player_at"""


add("gen_player_stats", "matches players", _stats("i * 10 + s", 1, 40, 20, 15, 1, (1, 3000), (30, 40)))
add(
    "gen_wide_player_stats",
    "matches players",
    _stats("((i - 1) * 2 + g - 1) * 8 + s", 2, 40, 25, 20, 0, (100, 4500), (25, 55)),
)
add(
    "gen_elo_history",
    "player_stats players",
    f"""+ s AS (
      SELECT row_number() OVER (ORDER BY player_id, match_id) AS id, player_id, match_id FROM player_stats)
    SELECT s.id, player_id, match_id, elo_rating AS elo_before,
           (CASE WHEN {_draw('elo_side', 's.id')} < 0.5 THEN 1200 - {_below(500, 'elo_step', 's.id')}
                 ELSE 1200 + {_below(500, 'elo_step', 's.id')} END)::INT AS elo_after,
           {_ago(_NOW, 365 * 86400, 'elo_time', 's.id')} AS changed_at
    FROM s JOIN players p ON p.id = player_id""",
)
add(
    "gen_bans",
    "players",
    f"""SELECT row_number() OVER (ORDER BY id) AS id, id AS player_id, 'Violation of terms of service' AS reason,
        {_NOW} - INTERVAL 7 DAY AS banned_at, {_NOW} + INTERVAL 30 DAY AS expires_at, false AS is_permanent
        FROM players WHERE {_draw('ban', 'id')} < 0.1""",
)
add(
    "gen_payouts",
    "players teams tournaments",
    f"""+ p AS (SELECT id AS player_id, row_number() OVER (ORDER BY id) AS id FROM players),
    t AS (SELECT id AS team_id, row_number() OVER (ORDER BY {_draw('payout_team', 'id')}, id) AS id FROM teams),
    u AS (SELECT id AS tournament_id,
                 row_number() OVER (ORDER BY {_draw('payout_tournament', 'id')}, id) AS id FROM tournaments)
    SELECT id, tournament_id, team_id, player_id,
           (50000 + {_below(50000, 'payout_amount', 'id')})::DOUBLE AS amount,
           {_ago(_NOW, 365 * 86400, 'payout_time', 'id')} AS paid_at
    FROM p JOIN t USING (id) JOIN u USING (id)""",
)

# jobs: status and row counts of their steps


def _job(job: str, steps: dict[str, str]) -> str:
    rows = [
        f"SELECT '{job}' AS job, '{step}' AS step, {i}::INT AS position, 'ok' AS status, ({count})::BIGINT AS n_rows"
        for i, (step, count) in enumerate(steps.items(), start=1)
    ]
    return " UNION ALL ".join(rows)


def _rows_of(*names: str) -> str:
    return " + ".join(f"(SELECT count(*) FROM ({ORACLE[name]}))" for name in names)


_MARTS_BUILT = "SELECT " + _rows_of(
    "player_performance", "tournament_standings", "country_leaderboard", "prize_earnings"
)
_KEPT = f"SELECT count(*) FROM ({ORACLE['changelog_compact']})"
add(
    "nightly_job",
    "",
    _job(
        "nightly",
        {
            "load_matches": f"SELECT count(*) FROM orders WHERE o_orderdate <= {_NOW}",
            "validate_stats": "SELECT 0",
            "refresh_players": "SELECT count(*) FROM customer",
            "build_models": _MARTS_BUILT,
            "maintenance": _KEPT,
        },
    ),
)
add(
    "weekly_job",
    "",
    _job(
        "weekly",
        {
            "cache_top_players": "SELECT least(50, count(*)) FROM customer",
            "build_models": _MARTS_BUILT,
            "maintenance": _KEPT,
        },
    ),
)
add(
    "monthly_job",
    "",
    _job(
        "monthly",
        {
            "snapshot": f"SELECT sum(n_rows) FROM ({ORACLE['snapshot_manifest']})",
            "retention": "SELECT 0",
        },
    ),
)
add(
    "local_export_job",
    "",
    _job(
        "local_export",
        {
            "maintenance": _KEPT,
            "export_matches": f"SELECT count(*) FROM ({ORACLE['incr_matches_closed']})",
            "export_rankings": "SELECT least(100, count(*)) FROM customer",
        },
    ),
)
_LAKE = {
    "int_player_match_summary": "int_player_match_summary",
    "int_team_match_summary": "int_team_match_summary",
    "tournament_standings": "tournament_standings",
}
add(
    "lake_export_job",
    "",
    " UNION ALL ".join(
        _job("lake_export", {name: f"SELECT count(*) FROM ({ORACLE[name]})"}) for name in _LAKE
    ),
)
_KEPT_QUERIES = {
    "KDA_Ranking": ORACLE["top_kda"],
    "Winrate_Per_Tournament": ORACLE["win_rate_first_10"],
    "Avg_Damage_Per_Match": f"{ORACLE['avg_damage']} LIMIT 10",
    "Elo_Gainers_Last_30d": ORACLE["most_improved"],
    "Tournaments_With_Many_Matches": ORACLE["frequent_pairs"],
    "Top_Prize_Players": ORACLE["top_prize_players"],
    "Top_Elo_Players": "SELECT c_custkey FROM customer LIMIT 10",
    "Last_10_Matches_Per_Player": ORACLE["last10_first_rows"],
}
add(
    "named_queries_kept",
    "",
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS n_rows FROM ({text})" for name, text in _KEPT_QUERIES.items()
    ),
)

# listings of files whose sizes and times follow from the rows written
_LAKE = """SELECT c_nationkey AS nation, sum(strlen(c_custkey || '|' || c_name) + 1)::BIGINT AS n_bytes FROM customer GROUP BY ALL"""
add("lake_file_listing", "", f"SELECT nation, n_bytes FROM ({_LAKE})")
add(
    "retention_candidates",
    "",
    f"""SELECT count(*) AS n_files, round(coalesce(sum(n_bytes), 0) / 1048576.0, 2)::DOUBLE AS mb
        FROM ({_LAKE}) WHERE nation < 12""",
)
add("retention_deletes", "", f"SELECT nation, 1::BIGINT AS n_files, n_bytes, nation < 12 AS gone FROM ({_LAKE})")
_SIZED = {"nation": ("n_nationkey", "n_name"), "customer": ("c_custkey", "c_name"), "supplier": ("s_suppkey", "s_name")}
add(
    "table_sizes",
    "",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, sum(strlen({key} || '|' || {text}) + 1)::BIGINT AS n_bytes FROM {name}"
        for name, (key, text) in _SIZED.items()
    ),
)
