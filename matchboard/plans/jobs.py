"""The scheduled jobs as plain functions: named steps that run in order and stop at the first failure."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import analytics as A
from ..operators.analytics import slow_queries, top_players
from ..operators.changes import changelog_bloat, changelog_compact
from ..operators.quality import negative_stats
from ..sources import readers, results, writers
from ..streaming import feeds
from .checks import write_tested
from .models import VIEWS, Models

RUN_LOG = T.StructType(
    [
        T.StructField("job", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("duration_us", T.LongType()),
        T.StructField("message", T.StringType()),
    ]
)
RESULT_TTL_S = 3600  # fixed value: how long a stored result is valid
KEEP_DAYS = 90  # fixed value: how long backups are kept

Step = tuple[str, Callable[[], int | None]]


def run_steps(spark: SparkSession, job: str, steps: Sequence[Step]) -> DataFrame:
    """Run log, one row per step: ok, failed (with the message) or skipped after a failure.

    A step returns the number of rows it wrote or found, or None.
    """
    log, failed = [], False
    for position, (name, step) in enumerate(steps, start=1):
        if failed:
            log.append((job, name, position, "skipped", None, None, None))
            continue
        started = time.monotonic()
        try:
            n_rows, status, message = step(), "ok", None
        except Exception as error:  # a failing step ends the job but not the log
            n_rows, status, message, failed = None, "failed", str(error).splitlines()[0][:200], True
        log.append((job, name, position, status, n_rows, int((time.monotonic() - started) * 1e6), message))
    return spark.createDataFrame(log, RUN_LOG)


def run_log_summary(log: DataFrame, k: int | None = 5) -> DataFrame:
    """Calls, mean and total time per step, slowest first."""
    return slow_queries(log.select(F.col("step").alias("query_name"), "duration_us"), k)


_WATERMARKS = T.StructType([T.StructField("id", T.LongType()), T.StructField("point_of_time", T.TimestampNTZType())])


def _move_watermark(spark: SparkSession, loaded: DataFrame, root: str, first_load: str) -> None:
    """Store the latest time loaded; it never moves back."""
    registry = results.read_or_empty(spark, f"{root}/watermarks", _WATERMARKS)
    low = readers.watermark_state(registry, first_load).first()["point_of_time"]
    newest = readers.watermark_advance(registry, loaded.filter(F.col("played_at") > F.lit(low)), "played_at")
    newest.orderBy(F.desc("id")).limit(1).write.mode("append").parquet(f"{root}/watermarks")


def _copy_to_lake(spark: SparkSession, root: str, as_of: str) -> DataFrame:
    """The rows that a run has stored, copied as CSV; a run that is repeated replaces its copy."""
    stored = spark.read.parquet(f"{root}/new_matches").filter(F.col("loaded_at") == F.lit(as_of).cast("timestamp_ntz"))
    rows = stored.drop("loaded_at")
    writers.write(rows, writers.stamped(f"{root}/lake/matches", as_of), "csv")
    return rows


def load_matches(
    spark: SparkSession, matches: DataFrame, root: str, as_of: str, first_load: str = readers.FIRST_LOAD
) -> int:
    """Load matches of a table since the watermark, copy them to the lake as CSV, then move the watermark.

    No row limit: the rows of one run are one append. The watermark is the latest time loaded and is
    written last, so a run that fails is simply repeated. Returns how many rows were stored. Matches that turn up
    with a time before the watermark are not seen: see ``load_arrivals``.
    """
    registry = results.read_or_empty(spark, f"{root}/watermarks", _WATERMARKS)
    low = readers.watermark_state(registry, first_load).first()["point_of_time"]
    batch = readers.incremental(matches, "played_at", F.lit(low), F.lit(as_of).cast("timestamp_ntz"))
    stored = results.append_new(results.as_new_matches(batch, as_of), f"{root}/new_matches", "id", "played_at")
    if stored:
        _move_watermark(spark, _copy_to_lake(spark, root, as_of), root, first_load)
    return stored


def load_arrivals(
    spark: SparkSession, matches: DataFrame, root: str, as_of: str, first_load: str = readers.FIRST_LOAD
) -> int:
    """Load matches as they arrive, whenever they were played: ``matches`` is a stream of files.

    The stream's own log says which files were read, so a late match is loaded, and a file once. Its place in
    the log moves after the rows are stored, and a batch that is delivered again is stored once. The watermark goes
    on telling the latest time loaded. Returns how many rows were stored.
    """
    stored = []
    target, seen = f"{root}/new_matches", f"{root}/arrivals"

    def write(batch: DataFrame, _: int) -> None:
        stored.append(results.append_new(results.as_new_matches(batch, as_of), target, "id", "played_at"))

    feeds.run_available(matches, seen, write)
    if sum(stored):
        _move_watermark(spark, _copy_to_lake(spark, root, as_of), root, first_load)
    return sum(stored)


def validate_stats(stats: DataFrame, root: str, as_of: str) -> int:
    """Append the messages about negative statistics to the validation log, under the run's time."""
    path = f"{root}/validation_log/run={datetime.fromisoformat(as_of):%Y%m%d%H%M%S}"
    negative_stats(stats).write.mode("overwrite").parquet(path)
    return stats.sparkSession.read.parquet(path).count()


# Named queries whose results are worth keeping; the names are fixed values.
NAMED_QUERIES: dict[str, Callable] = {
    "KDA_Ranking": lambda t, as_of: A.top_kda(t["player_stats"]),
    "Winrate_Per_Tournament": lambda t, as_of: A.win_rate(t["matches"], 10),
    "Avg_Damage_Per_Match": lambda t, as_of: A.avg_damage(t["player_stats"]).orderBy("match_id", "player_id").limit(10),
    "Elo_Gainers_Last_30d": lambda t, as_of: A.most_improved(t["elo_history"], as_of),
    "Tournaments_With_Many_Matches": lambda t, as_of: A.frequent_pairs(t["matches"]),
    "Top_Prize_Players": lambda t, as_of: A.prize_by_player(t["prize_payouts"], 10),
    "Top_Elo_Players": lambda t, as_of: A.top_players(t["players"], 10),
    "Last_10_Matches_Per_Player": lambda t, as_of: A.last_n_per_player(t["player_stats"], 10, limit=10),
}


def named_query(spark: SparkSession, tables, name: str, root: str, as_of: str) -> DataFrame:
    """A named query's stored result while it is valid, else its result, stored now."""
    if name not in NAMED_QUERIES:
        raise KeyError(f"unknown query {name}")
    store = results.ResultStore(spark, f"{root}/results")
    return store.cached_query(name, lambda: NAMED_QUERIES[name](tables, as_of), RESULT_TTL_S, as_of)


def keep_slowest(spark: SparkSession, tables, root: str, as_of: str, repeats: int = 50, k: int = 3) -> DataFrame:
    """Time every named query and store the results of the ``k`` slowest; returns the run log."""

    def timed(name: str) -> Callable[[], None]:
        def run() -> None:
            for _ in range(repeats):
                NAMED_QUERIES[name](tables, as_of).write.format("noop").mode("overwrite").save()

        return run

    log = run_steps(spark, "named_queries", [(name, timed(name)) for name in NAMED_QUERIES])
    for row in run_log_summary(log, k).collect():  # k rows
        named_query(spark, tables, row["query_name"], root, as_of)
    return log


def refresh_players(spark: SparkSession, players: DataFrame, root: str, as_of: str, top: int | None = None) -> int:
    """Store all players, or the ``top`` rated ones, as a result with a time to live."""
    store = results.ResultStore(spark, f"{root}/results")
    name, rows = ("players_all", players) if top is None else ("topplayers", top_players(players, top))
    return store.put(name, rows, RESULT_TTL_S, as_of).count()


def build_marts(tables, root: str) -> int:
    """Build all models, write the marts and keep the report of their tests."""
    built, report = write_tested(tables, f"{root}/marts")
    report.write.mode("overwrite").parquet(f"{root}/model_tests")
    return sum(built[name].count() for name in built if name not in VIEWS)


def maintain(log: DataFrame, root: str, key: str = "id", version: str = "version") -> int:
    """Compact the change log when more than 15 % of it is superseded; returns the rows kept."""
    if changelog_bloat(log, key, version).isEmpty():
        return 0
    path = f"{root}/compacted"
    changelog_compact(log, key, version).write.mode("overwrite").parquet(path)
    return log.sparkSession.read.parquet(path).count()


def nightly(
    spark: SparkSession,
    tables,
    root: str,
    as_of: str,
    first_load: str = readers.FIRST_LOAD,
    arriving: DataFrame | None = None,
) -> DataFrame:
    """Load, validate, refresh, build, maintain. Matches come from a stream of files, if ``arriving`` is given."""
    log = tables["player_changes"].withColumn("table_name", F.lit("players"))

    def load() -> int:
        if arriving is None:
            return load_matches(spark, tables["matches"], root, as_of, first_load)
        return load_arrivals(spark, arriving, root, as_of, first_load)

    return run_steps(
        spark,
        "nightly",
        [
            ("load_matches", load),
            ("validate_stats", lambda: validate_stats(tables["player_stats"], root, as_of)),
            ("refresh_players", lambda: refresh_players(spark, tables["players"], root, as_of)),
            ("build_models", lambda: build_marts(tables, root)),
            ("maintenance", lambda: maintain(log, root)),
        ],
    )


def weekly(spark: SparkSession, tables, root: str, as_of: str) -> DataFrame:
    """Store the top 50, build, maintain."""
    log = tables["player_changes"].withColumn("table_name", F.lit("players"))
    return run_steps(
        spark,
        "weekly",
        [
            ("cache_top_players", lambda: refresh_players(spark, tables["players"], root, as_of, 50)),
            ("build_models", lambda: build_marts(tables, root)),
            ("maintenance", lambda: maintain(log, root)),
        ],
    )


def monthly(
    spark: SparkSession, tables, names: Sequence[str], root: str, as_of: str, dry_run: bool = True
) -> DataFrame:
    """Snapshot every table, then drop snapshots older than the retention time."""

    def backup() -> int:
        manifest = writers.snapshot(spark, {name: tables[name] for name in names}, root, as_of)
        return manifest.agg(F.sum("n_rows")).first()[0]

    def clean() -> int:
        return writers.retention(spark, f"{root}/backup*", as_of, KEEP_DAYS, dry_run).count()

    return run_steps(spark, "monthly", [("snapshot", backup), ("retention", clean)])


def local_export(spark: SparkSession, tables, root: str, as_of: str, since: str) -> DataFrame:
    """Maintain, export matches since the watermark, export the rankings."""
    log = tables["player_changes"].withColumn("table_name", F.lit("players"))

    def export_matches() -> int:
        low, high = (F.lit(t).cast("timestamp_ntz") for t in (since, as_of))
        rows = readers.incremental(tables["matches"], "played_at", low, high, closed=True)
        writers.write(rows.orderBy(F.desc("played_at")), writers.stamped(f"{root}/matches", as_of), "csv")
        return rows.count()

    def export_rankings() -> int:
        best = top_players(tables["players"], 100)
        for fmt in ("csv", "json"):
            writers.write(best, writers.stamped(f"{root}/ranking/top_100_players_{fmt}", as_of), fmt)
        return best.count()

    return run_steps(
        spark,
        "local_export",
        [
            ("maintenance", lambda: maintain(log, root)),
            ("export_matches", export_matches),
            ("export_rankings", export_rankings),
        ],
    )


def lake_export(spark: SparkSession, tables, root: str, run_date: str, limit: int | None = None) -> DataFrame:
    """Three models as CSV and Parquet under the run date, whole or the first ``limit`` rows of each.

    A model that fails is logged; the others go on.
    """
    models = Models(tables)
    orders = {
        "int_player_match_summary": ["player_id", "match_id", "stat_id", "kills", "deaths", "assists"],
        "int_team_match_summary": ["tournament_id", "team_a_id"],
        "tournament_standings": ["rank", "team_id"],
    }

    def export(name: str) -> int:
        rows = models[name]
        if limit is not None:
            rows = readers.bounded_extract(rows, [F.asc(c) for c in orders[name]], limit)
        writers.write_dated(rows, f"{root}/{name}/parquet", run_date, "parquet")
        written = writers.read_dated(spark, f"{root}/{name}/parquet", run_date, rows.schema)  # not worked out twice
        writers.write_dated(written, f"{root}/{name}/csv", run_date, "csv")
        return spark.read.parquet(f"{root}/{name}/parquet").count()

    logs = [run_steps(spark, "lake_export", [(name, lambda name=name: export(name))]) for name in orders]
    result = logs[0]
    for log in logs[1:]:
        result = result.unionByName(log)
    return result
