"""The match tables, as views over the given Parquet tables.

One text per view serves both engines: Spark fills the braces with DataFrames, the comparison SQL
with table names.

Every id runs over its whole domain, so that the views grow with the tables in keys as well as in rows. Half of
the matches share a hundred large tournaments, the others are spread. The given tables hold four parts to three
customers at every size; that maps a part to a player.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.generate import BAN_REASON, FIRST_DAY, ROLES

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

_ROLE = "CASE c_custkey % 5 " + " ".join(f"WHEN {i} THEN '{role}'" for i, role in enumerate(ROLES[:-1])) + f" ELSE '{ROLES[-1]}' END"

VIEWS: dict[str, str] = {
    "players": """
        SELECT c_custkey AS id, c_name AS username, n_name AS country,
               DATE '1995-01-01' + CAST(c_custkey % 4500 AS INT) AS date_of_birth,
               CAST(1000 + floor(c_acctbal / 5) AS INT) AS elo_rating,
               {ntz}'2023-01-01 00:00:00' + INTERVAL '1' DAY * CAST(c_custkey % 1000 AS INT) AS created_at
        FROM {customer} AS customer JOIN {nation} AS nation ON c_nationkey = n_nationkey""",
    "teams": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, r_name AS region,
               DATE '<first day>' + CAST(n_nationkey AS INT) AS founded_at,
               CAST(50000 + n_nationkey * 1000 AS DECIMAL(15,2)) AS prize_pool, n_nationkey % 2 = 0 AS is_active
        FROM {nation} AS nation JOIN {region} AS region ON n_regionkey = r_regionkey""",
    "tournaments": """
        SELECT p_partkey AS id, concat('tournament', CAST(p_partkey AS STRING)) AS name, p_type AS game,
               CAST(p_retailprice AS DECIMAL(15,2)) AS prize_pool,
               {ntz}'2026-01-01 00:00:00' + INTERVAL '1' DAY * CAST(p_partkey % 365 AS INT) AS starts_at,
               CASE p_partkey % 4 WHEN 0 THEN 'upcoming' WHEN 1 THEN 'ongoing'
                                  WHEN 2 THEN 'completed' ELSE 'cancelled' END AS status
        FROM {part} AS part""",
    "matches": """
        SELECT o_orderkey AS id,
               CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey * 7 + o_custkey) % 100 ELSE o_custkey END AS tournament_id,
               o_custkey % 25 AS team_a_id, (o_custkey + 1 + o_orderkey % 24) % 25 AS team_b_id,
               CASE WHEN CAST(floor(o_totalprice) AS BIGINT) % 2 = 0 THEN o_custkey % 25
                    ELSE (o_custkey + 1 + o_orderkey % 24) % 25 END AS winner_id,
               o_orderdate AS played_at
        FROM {orders} AS orders""",
    "player_stats": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS match_id,
               CAST((l_partkey * 3 - l_partkey * 3 % 4) / 4 AS BIGINT) AS player_id,
               CAST(l_quantity AS INT) AS kills, l_linenumber - 1 AS deaths, CAST(l_suppkey % 20 AS INT) AS assists,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS damage_dealt,
               CAST(l_discount * 1000 AS DECIMAL(5,2)) AS headshot_pct
        FROM {lineitem} AS lineitem""",
    "elo_history": """
        SELECT o_orderkey AS id, o_custkey AS player_id, o_orderkey AS match_id,
               CAST(1000 + o_custkey % 500 AS INT) AS elo_before,
               CAST(700 + CAST(floor(o_totalprice) AS BIGINT) % 1000 AS INT) AS elo_after, o_orderdate AS changed_at
        FROM {orders} AS orders""",
    "team_rosters": """
        SELECT c_custkey AS id, c_custkey % 25 AS team_id, c_custkey - c_custkey % 4 AS player_id,
               <role> AS role,
               DATE '<first day>' + CAST(c_custkey % 365 AS INT) AS joined_at,
               CASE WHEN c_custkey % 3 = 0 THEN NULL
                    ELSE DATE '2001-10-12' + CAST(c_custkey % 365 AS INT) END AS left_at
        FROM {customer} AS customer""",
    "prize_payouts": """
        SELECT o_orderkey AS id,
               CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey * 7 + o_custkey) % 100 ELSE o_custkey END AS tournament_id,
               o_custkey % 25 AS team_id,
               o_custkey AS player_id, CAST(o_totalprice AS DECIMAL(12,2)) AS amount, o_orderdate AS paid_at
        FROM {orders} AS orders""",
    "player_bans": """
        SELECT event_id AS id, user_id AS player_id, '<reason>' AS reason, ts AS banned_at,
               ts + INTERVAL '37' DAY AS expires_at, FALSE AS is_permanent
        FROM {events} AS events WHERE event_type = 'error'""",
    "players_before": """
        SELECT id, username, country,
               CASE WHEN elo_rating < 1500 THEN elo_rating - 100 ELSE elo_rating END AS elo_rating
        FROM {players} AS players WHERE created_at < {ntz}'2025-07-01 00:00:00'
        UNION ALL
        SELECT -1 - s_suppkey, s_name, n_name, CAST(1000 + floor(s_acctbal / 5) AS INT)
        FROM {supplier} AS supplier JOIN {nation} AS nation ON s_nationkey = n_nationkey""",
    "player_changes": """
        SELECT user_id AS id, event_id AS version, ts AS changed_at,
               CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS operation,
               CAST(1000 + floor(value) AS INT) AS elo_rating
        FROM {events} AS events""",
    "query_runs": """
        SELECT event_type AS query_name, event_id AS run_id, CAST(round(value * 100) AS BIGINT) AS duration_us
        FROM {events} AS events""",
}
for _name, _text in VIEWS.items():
    VIEWS[_name] = _text.replace("<role>", _ROLE).replace("<reason>", BAN_REASON).replace("<first day>", FIRST_DAY)

# The tables a copy of everything holds.
MATCH_TABLES = (
    "players",
    "teams",
    "tournaments",
    "matches",
    "player_stats",
    "elo_history",
    "team_rosters",
    "prize_payouts",
    "player_bans",
)

# Fixed parameters of the checked queries.
AS_OF = "2001-08-01 00:00:00"
EVENTS_AS_OF = "2024-01-30 00:00:00"
WATERMARK = "2001-06-01 00:00:00"


def _inputs(view: str) -> list[str]:
    return [name for name in (*BASE_TABLES, *VIEWS) if "{" + name + "}" in VIEWS[view]]


class Tables:
    """The match tables of one data folder; each is a lazy DataFrame, built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str, given: dict[str, DataFrame] | None = None):
        self.spark, self.folder = spark, folder
        self._known: dict[str, DataFrame] = dict(given or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            if name in VIEWS:
                inputs = {source: self[source] for source in _inputs(name)}
                self._known[name] = self.spark.sql(VIEWS[name].replace("{ntz}", "TIMESTAMP_NTZ"), **inputs)
            else:
                self._known[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._known[name]


_OPENED: dict[tuple, Tables] = {}


def open_tables(spark: SparkSession, folder: str) -> Tables:
    """The tables of a folder, looked up once per session: files listed, schemas read, views analysed.

    No data is kept. A folder whose files are replaced needs a new ``Tables``.
    """
    key = (spark.sparkContext.applicationId, id(spark), folder)
    if key not in _OPENED:
        _OPENED[key] = Tables(spark, folder)
    return _OPENED[key]


def view_sql(*names: str) -> str:
    """``name AS (...)`` clauses for the named views and the views they need, for a WITH list."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for source in _inputs(name):
            if source in VIEWS:
                add(source)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    plain = {name: name for name in (*BASE_TABLES, *VIEWS)}
    return ",\n".join(f"{name} AS ({VIEWS[name].format(ntz='TIMESTAMP ', **plain)})" for name in ordered)
