"""One named query per operator, each over the whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import functions as fn
from .cluster import cut_lineage, new_folder
from .operators import analytics as A
from .operators import changes as C
from .operators import network as N
from .operators import quality as Q
from .operators import ranking as R
from .operators import ratelimit as L
from .plans import generate as G
from .plans import jobs as J
from .plans.checks import check_models, write_tested
from .plans.models import MARTS, VIEWS, Models
from .schema import FOREIGN_KEYS
from .sources import readers, results, writers
from .sources.fixtures import AS_OF, EVENTS_AS_OF, MATCH_TABLES, WATERMARK, Tables, open_tables
from .streaming import feeds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_DATE = "2026-05-17"
CREATORS = ("association1", "association2", "association3", "association4", "association5")  # fixed values
RATE = {"max_calls": 2, "seconds": 86400}


def query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a function of the tables under its own name."""
    QUERIES[function.__name__] = lambda spark, folder: function(open_tables(spark, folder))
    return function


def _model(name: str) -> None:
    QUERIES[name] = lambda spark, folder: _plain(Models(open_tables(spark, folder))[name])


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, as the comparison SQL returns them."""
    columns = [
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*columns)


for _name in (*VIEWS, *MARTS):
    _model(_name)


# scans and sources


@query
def scan_players(t):
    return t["players"]


@query
def incr_matches_halfopen(t):
    low, high = A.at(WATERMARK), A.at(AS_OF)
    return readers.incremental(t["matches"], "played_at", low, high).orderBy("played_at", "id")


@query
def incr_matches_closed(t):
    low, high = A.at(WATERMARK), A.at(AS_OF)
    return readers.incremental(t["matches"], "played_at", low, high, closed=True).orderBy(F.desc("played_at"), "id")


def _registry(t) -> DataFrame:
    return t["events"].select(F.col("event_id").alias("id"), F.col("ts").alias("point_of_time"))


@query
def watermark_state(t):
    return readers.watermark_state(_registry(t), readers.FIRST_LOAD)


@query
def watermark_advance(t):
    loaded = readers.incremental(t["matches"], "played_at", A.at(WATERMARK), A.at(AS_OF))
    return readers.watermark_advance(_registry(t), loaded, "played_at")


@query
def json_roundtrip(t):
    players = t["players"]
    path = writers.write(players, new_folder(t.spark, "json"), "json")
    return t.spark.read.schema(players.schema).option("timestampNTZFormat", readers.ISO).json(path)


@query
def json_records(t):
    players = t["players"].select("id", "username", "country", "elo_rating")
    return readers.from_json_records(players.select(F.to_json(F.struct("*")).alias("j")), "j", players.schema)


@query
def json_extract(t):
    value = F.get_json_object("props", "$.k").cast("long")
    return t["events"].select("event_id", value.alias("k"))


def _line(key: str, text: str):
    return F.concat_ws("|", F.col(key).cast("string"), text).alias("line")


def _customer_lake(t) -> str:
    """A text file of customers per nation, last changed as many days after the first of 2020 as the nation's number."""
    folder = f"{new_folder(t.spark, 'lake')}/customers"
    lines = t["customer"].select("c_nationkey", _line("c_custkey", "c_name")).repartition("c_nationkey")
    lines.write.partitionBy("c_nationkey").text(folder)
    jvm = t.spark.sparkContext._jvm
    first = datetime(2020, 1, 1, tzinfo=timezone.utc).timestamp() * 1000
    for row in readers.lake_files(t.spark, folder).select("path", _nation("path").alias("nation")).collect():  # 25
        path = jvm.org.apache.hadoop.fs.Path(row.path)
        path.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration()).setTimes(path, int(first + row.nation * 86_400_000), -1)
    return folder


def _nation(path: str):
    return F.regexp_extract(path, "c_nationkey=([0-9]+)", 1).cast("int")


@query
def lake_file_listing(t):
    return readers.lake_files(t.spark, _customer_lake(t)).select(_nation("path").alias("nation"), F.col("length").alias("n_bytes"))


@query
def table_sizes(t):
    base = new_folder(t.spark, "sizes")
    for name, line in (("nation", ("n_nationkey", "n_name")), ("customer", ("c_custkey", "c_name")), ("supplier", ("s_suppkey", "s_name"))):
        t[name].select(_line(*line)).write.text(f"{base}/{name}")
    return readers.table_sizes(readers.lake_files(t.spark, base), base).select("table_name", "n_bytes")


@query
def csv_schema_drift(t):
    matches = t["matches"]
    older = matches.filter(F.col("played_at") < A.at(WATERMARK))
    newer = C.backfill(matches.filter(F.col("played_at") >= A.at(WATERMARK)), "created_by", CREATORS, "id")
    written = [(writers.write(df, new_folder(t.spark, "csv"), "csv"), df.schema) for df in (older, newer)]
    return readers.read_csv_versions(t.spark, written)


@query
def gen_series(t):
    last = t["orders"].agg(F.max("o_orderkey")).first()[0] or 0
    return G.series(t.spark, 1, last + 1)


@query
def bounded_extract(t):
    summary = Models(t)["int_team_match_summary"]
    return readers.bounded_extract(summary, [F.asc("tournament_id"), F.asc("team_a_id")], 1000)


# sinks and stored results


@query
def export_csv_roundtrip(t):
    matches = t["matches"]
    path = writers.write(matches, new_folder(t.spark, "csv"), "csv")
    return readers.read_csv(t.spark, path, matches.schema)


@query
def export_csv_text(t):
    """Whole texts with their line breaks, empty and missing ones, and some that look like the mark of a missing one."""
    kind = F.col("doc_id") % 7
    text = F.when(kind == 0, "").when(kind == 1, F.lit(None).cast("string")).when(kind == 2, "\\N").when(kind == 3, "\\\\N").otherwise(F.col("text"))
    docs = t["documents"].select("doc_id", text.alias("text"), "lang", "source", "n_chars")
    path = writers.write(docs, new_folder(t.spark, "csv"), "csv")
    return readers.read_csv(t.spark, path, docs.schema)


@query
def export_parquet_roundtrip(t):
    path = writers.write(t["player_stats"], new_folder(t.spark, "parquet"))
    return _plain(t.spark.read.parquet(path))


@query
def partition_layout(t):
    matches = t["matches"]
    base = new_folder(t.spark, "dated")
    writers.write_dated(matches, base, RUN_DATE)
    date_parts = [T.StructField(c, T.StringType()) for c in ("year", "month", "day")]
    dated = T.StructType([*matches.schema.fields, *date_parts])
    stored = t.spark.read.schema(dated).parquet(base)
    return stored.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def load_new_matches(t):
    batch = readers.incremental(t["matches"], "played_at", A.at(WATERMARK), A.at(AS_OF))
    batch = results.as_new_matches(batch, AS_OF)
    target = new_folder(t.spark, "new_matches")
    for moved in range(2):  # the second delivery adds nothing, though its times have moved by a day
        again = batch.withColumn("played_at", F.col("played_at") + F.make_dt_interval(F.lit(moved)))
        results.append_new(again, target, "id", "played_at")
    return t.spark.read.parquet(target)


@query
def snapshot_manifest(t):
    return writers.snapshot(t.spark, {n: t[n] for n in MATCH_TABLES}, new_folder(t.spark, "snapshot"), AS_OF)


@query
def cached_query_hit(t):
    store = results.ResultStore(t.spark, new_folder(t.spark, "results"))
    store.cached_query("win_rate", lambda: A.win_rate(t["matches"]), 3600, "2026-05-17 12:00:00")

    def must_not_run() -> DataFrame:
        raise AssertionError("a valid result was computed again")

    return store.cached_query("win_rate", must_not_run, 3600, "2026-05-17 12:59:59")


@query
def cache_expired(t):
    entries = t["events"].select(
        F.col("event_id"), F.col("ts").alias("computed_at"), F.lit(3600).cast("long").alias("ttl_s")
    )
    return results.mark_expired(entries, EVENTS_AS_OF)


@query
def leaderboard_snapshot(t):
    return results.leaderboard_snapshot(t["players"], new_folder(t.spark, "leaderboard"))


@query
def top50_players(t):
    store = results.ResultStore(t.spark, new_folder(t.spark, "results"))
    return store.put("topplayers", A.top_players(t["players"], 50), J.RESULT_TTL_S, "2026-05-17 12:00:00")


@query
def cache_stats(t):
    return A.cache_stats(t["players"].select("id", "username", "country", "elo_rating"))


LAKE_AS_OF = "2020-01-23 00:00:00"  # ten days and twelve nations after the first


@query
def retention_candidates(t):
    return writers.retention_report(readers.lake_files(t.spark, _customer_lake(t)), LAKE_AS_OF, 10)


@query
def retention_deletes(t):
    """Files by nation, and whether retention removed them."""
    folder = _customer_lake(t)
    before = readers.lake_files(t.spark, folder).select(_nation("path").alias("nation"), F.col("length").alias("n_bytes"))
    before = cut_lineage(before)
    removed = writers.retention(t.spark, folder, LAKE_AS_OF, 10, dry_run=False)
    removed = removed.select(_nation("folder").alias("nation"), "n_files", F.col("n_bytes").alias("removed"))
    left = readers.lake_files(t.spark, folder).select(_nation("path").alias("nation"), F.lit(1).cast("long").alias("here"))
    every = before.join(removed, "nation", "left").join(left, "nation", "left")
    gone = (F.col("removed") == F.col("n_bytes")) & F.col("here").isNull()
    return every.select("nation", F.coalesce("n_files", "here").alias("n_files"), "n_bytes", F.coalesce(gone, F.lit(False)).alias("gone"))


# projections, filters, updates


@query
def elo_delta(t):
    return A.elo_delta(t["elo_history"])


@query
def elo_last_30d(t):
    return A.elo_last_days(t["elo_history"], AS_OF)


@query
def win_flag(t):
    return A.win_flags(t["matches"])


@query
def player_lookup(t):
    return A.lookup(t["players"], t["events"].select("user_id"))


def _rating_updates(t) -> DataFrame:
    return t["player_changes"].filter("operation <> 'DELETE'")


@query
def apply_elo_updates(t):
    updated, _ = C.apply_updates(t["players"], _rating_updates(t), "id", ["elo_rating"], "version")
    return updated


@query
def unmatched_elo_updates(t):
    rated = t["teams"].withColumn("elo_rating", F.lit(0))
    _, unmatched = C.apply_updates(rated, _rating_updates(t), "id", ["elo_rating"], "version")
    return unmatched


@query
def write_through_leaderboard(t):
    _, board, _ = results.write_through(t["players"], _rating_updates(t), "version", new_folder(t.spark, "board"))
    return board


@query
def bulk_elo_shift(t):
    return C.shift_rating(t["players"], 100).select("id", "elo_rating")


@query
def backfill_created_by(t):
    return C.backfill(t["matches"], "created_by", CREATORS, "id").select("id", "created_by")


@query
def drop_created_by(t):
    return C.backfill(t["matches"], "created_by", CREATORS, "id").drop("created_by")


@query
def validate_new_players(t):
    born = F.lit("1995-01-01").cast("date")
    texts = t["documents"].select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("username"),
        F.col("lang").alias("country"),
        born.alias("date_of_birth"),
    )
    candidates = t["players"].select("id", "username", "country", "date_of_birth").unionByName(texts)
    return Q.judge_new_players(candidates, AS_OF)


# scalar functions


def _damaged(t) -> DataFrame:
    """Documents; every third text ends in a cut-off character and a bracket."""
    broken = F.when(F.col("doc_id") % 3 == 0, F.unhex(F.lit("C328"))).otherwise(F.unhex(F.lit("")))
    damaged = F.concat(F.encode("text", "UTF-8"), broken).cast("string")
    return t["documents"].withColumn("text", damaged)


@query
def clean_text(t):
    return _damaged(t).select("doc_id", fn.clean_text("text").alias("text"))


@query
def interval_math(t):
    played = F.col("played_at")
    return t["matches"].select(
        "id",
        (played - F.make_dt_interval(F.lit(7))).alias("week_before"),
        (played + F.make_dt_interval(secs=(F.col("id") % 86400).cast("decimal(18,6)"))).alias("seconds_after"),
        F.date_add(played.cast("date"), (F.col("id") % 365).cast("int")).alias("days_after"),
    )


@query
def tz_convert(t):
    local = F.convert_timezone(F.lit("UTC"), F.lit("Asia/Kolkata"), F.col("played_at"))
    return t["matches"].select("id", local.alias("played_local"))


@query
def iso_timestamps(t):
    return t["players"].select("id", fn.iso_timestamp("created_at").alias("created_at"))


@query
def size_labels(t):
    key = F.col("o_orderkey").cast("decimal(38,0)")  # the cube of a key above 2,097,151 is no long
    size = key * key * key
    return t["orders"].select("o_orderkey", fn.size_pretty(size).alias("size"))


@query
def streakcount_sql(t):
    fn.register_sql_functions(t.spark)
    return A.streak_from_history(t["matches"], run_length=lambda text: F.call_function("streakcount", text))


# analytical queries


@query
def top_kda(t):
    return A.top_kda(t["player_stats"])


@query
def top_kda_nulls_last(t):
    return A.top_kda(t["player_stats"], 10)


@query
def win_rate(t):
    return A.win_rate(t["matches"])


@query
def win_rate_first_10(t):
    return A.win_rate(t["matches"], 10)


@query
def avg_damage(t):
    return A.avg_damage(t["player_stats"])


@query
def avg_damage_bucketed(t):
    folder = new_folder(t.spark, "bucketed")
    name = "stats_by_match_" + folder.rsplit("-", 1)[-1]
    return A.avg_damage(writers.store_layout(t, "stats_by_match", name, folder, 8))


@query
def most_improved(t):
    return A.most_improved(t["elo_history"], AS_OF)


@query
def frequent_pairs(t):
    return A.frequent_pairs(t["matches"])


@query
def prize_by_player(t):
    return A.prize_by_player(t["prize_payouts"])


@query
def top_prize_players(t):
    return A.prize_by_player(t["prize_payouts"], 10)


@query
def top10_dense_rank(t):
    return A.top_players_ranked(t["players"], 10)


@query
def last10_per_player(t):
    return _plain(A.last_n_per_player(t["player_stats"]))


@query
def last10_first_rows(t):
    return _plain(A.last_n_per_player(t["player_stats"], 10, limit=10))


@query
def top_players_100(t):
    return A.top_players(t["players"], 100)


@query
def leaderboard_global(t):
    return A.leaderboard(t["players"], 100)


@query
def leaderboard_positional(t):
    return A.leaderboard(t["players"], 500, kind="positional")


@query
def leaderboard_enriched(t):
    ranked = R.rank_by_score(t["players"], "elo_rating").select(
        "rank", F.col("id").cast("string").alias("player_id"), F.col("elo_rating").cast("long").alias("elo_rating")
    )
    known = A.lookup(t["players"], t["events"].select("user_id"))
    return A.enrich_ranked(ranked, known)


@query
def dense_rank_all(t):
    return R.rank_by_score(t["players"], "elo_rating", "dense").select("id", "rank")


@query
def win_history(t):
    return A.win_history(t["matches"])


@query
def current_streak(t):
    return A.current_streak(t["matches"])


@query
def team_counters(t):
    return A.team_counters(t["matches"])


@query
def slow_queries(t):
    return A.slow_queries(t["query_runs"])


@query
def slowest_three(t):
    return A.slow_queries(t["query_runs"], 3)


@query
def run_log_summary(t):
    return J.run_log_summary(t["query_runs"].withColumnRenamed("query_name", "step"))


# numbering and joins by position


@query
def surrogate_ids(t):
    return R.zip_with_index(t["players"].select("id", "username"), [F.asc("username"), F.asc("id")])


@query
def gen_permutation(t):
    return G.permutation(t["players"].select("id"), "permutation")


@query
def zip_join(t):
    frames = [
        t["matches"].select(F.col("id").alias("match_id"), "played_at"),
        t["elo_history"].select(F.col("id").alias("elo_id"), "elo_after"),
        t["prize_payouts"].select(F.col("id").alias("payout_id"), F.col("amount").cast("double").alias("amount")),
    ]
    orders = [
        [F.desc("played_at"), F.asc("match_id")],
        [F.asc("elo_after"), F.asc("elo_id")],
        [F.asc("amount"), F.asc("payout_id")],
    ]
    return R.zip_join(frames, orders)


@query
def bucket_assign(t):
    players = t["players"].select(F.col("id").alias("player_id"))
    teams = t["teams"].select(F.col("id").alias("team_id"), "name")
    return R.bucket_assign(players, teams, 6, [F.asc("player_id")], [F.asc("name")])


# network


@query
def team_edges(t):
    return N.team_edges(t["matches"])


@query
def team_network(t):
    return N.team_network(t["matches"])


@query
def team_paths_k3(t):
    return N.team_paths(N.team_edges(t["matches"]), 3)


@query
def chain_paths_k8(t):
    steps = t["customer"].select(F.col("c_custkey").alias("src"), (F.col("c_custkey") + 1).alias("dst"))
    return N.team_paths(steps, 8)


@query
def team_path_counts_k4(t):
    return N.team_path_counts(N.team_edges(t["matches"]), 4)


@query
def sparse_path_counts_k8(t):
    """A chain on which every fifth step has ways back."""
    key = F.col("c_custkey")
    steps = t["customer"].select(key.alias("src"), (key + 1).alias("dst"))
    back = t["customer"].filter(key % 5 > 1).select((key + 1).alias("src"), (key - key % 5).alias("dst"))
    return N.team_path_counts(steps.unionByName(back), 8)


@query
def team_reach(t):
    return N.team_reach(N.team_edges(t["matches"]))


# data checks


def _shifted_stats(t) -> DataFrame:
    """Statistics with some values moved out of range."""
    return t["player_stats"].select(
        "id",
        "match_id",
        "player_id",
        (F.col("kills") - 5).alias("kills"),
        (F.col("deaths") - 1).alias("deaths"),
        (F.col("assists") - 2).alias("assists"),
        (F.col("headshot_pct") * 2).cast("double").alias("headshot_pct"),
    )


@query
def dq_not_null(t):
    return Q.not_null(t["team_rosters"], t["team_rosters"].columns)


@query
def dq_unique(t):
    return Q.unique(t["player_stats"], ["id"])


@query
def dq_accepted_range(t):
    players = Q.accepted_range(t["players"], {"elo_rating": (0, 4000)})
    stats = Q.accepted_range(_shifted_stats(t), {"headshot_pct": (0, 100), "kills": (0, None), "deaths": (None, 4)})
    return players.unionByName(stats)


@query
def dq_accepted_values(t):
    return Q.accepted_values(t["tournaments"], "status", ["upcoming", "completed", "ongoing"])


@query
def dq_singular(t):
    return Q.singular(Models(t)["prize_earnings"].filter("prize_pool < 1200"))


@query
def dq_negative_stats(t):
    return Q.negative_stats(_shifted_stats(t))


@query
def validation_log(t):
    """The messages of a validation step, as its log holds them."""
    root = new_folder(t.spark, "validation")
    J.validate_stats(_shifted_stats(t), root, AS_OF)
    return t.spark.read.option("basePath", f"{root}/validation_log").parquet(f"{root}/validation_log").drop("run")


@query
def dq_composite_pk(t):
    return Q.unique(t["player_stats"], ["match_id", "player_id"])


@query
def dq_active_roster(t):
    return Q.active_roster(t["team_rosters"])


@query
def quarantine_stats(t):
    return Q.judge(_shifted_stats(t), Q.stats_rules())


@query
def quarantine_split(t):
    valid, rejected = Q.quarantine(_shifted_stats(t), Q.stats_rules())
    parts = valid.select(F.lit("valid").alias("part"), F.lit(None).cast("string").alias("broken_rules")).unionByName(
        rejected.select(F.lit("rejected").alias("part"), "broken_rules")
    )
    return parts.groupBy("part", "broken_rules").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def dq_utf8(t):
    return Q.valid_utf8(_damaged(t), ["text", "lang", "source"])


@query
def model_tests(t):
    return check_models(Models(t))


@query
def marts_tested(t):
    """The same tests, those of single values counted while the marts are written."""
    return write_tested(t, new_folder(t.spark, "marts"))[1]


@query
def fk_violations(t):
    return Q.foreign_keys(t, (*FOREIGN_KEYS, ("lineitem", "l_suppkey", "teams")))


# changes


@query
def audit_diff(t):
    after = t["players"].select("id", "username", "country", "elo_rating")
    return C.audit_diff(t["players_before"], after, "id", "players", AS_OF)


@query
def audit_feed(t):
    return C.audit_feed(t["player_changes"], "id", "version", ["elo_rating"], "players")


def _logs(t) -> DataFrame:
    log = t["player_changes"]
    return log.withColumn("table_name", F.lit("players"))


@query
def changelog_bloat(t):
    return C.changelog_bloat(_logs(t), "id", "version")


@query
def changelog_compact(t):
    return C.changelog_compact(t["player_changes"], "id", "version")


# rate limit and streams


def _streamed(t, view: str, base: str) -> DataFrame:
    """A view over one table, with that table read as a stream."""
    return Tables(t.spark, t.folder, {base: feeds.stream_table(t.spark, t.folder, base)})[view]


@query
def rate_limit(t):
    calls = t["events"].select("user_id", "event_id", "ts")
    return L.rate_limit(calls, "user_id", "ts", "event_id", **RATE).select("user_id", "event_id", "allowed")


@query
def stream_rate_limit(t):
    calls = feeds.stream_table(t.spark, t.folder, "events").select("user_id", "event_id", "ts")
    folder = new_folder(t.spark, "rate")
    out, state, log = f"{folder}/out", f"{folder}/state", f"{folder}/log"
    feeds.limit_rate(calls, out, state, log, "user_id", "ts", "event_id", **RATE)
    return t.spark.read.option("basePath", out).parquet(out).select("user_id", "event_id", "allowed")


@query
def stream_rate_limit_state(t):
    calls = feeds.stream_table(t.spark, t.folder, "events", files_per_batch=16).select("user_id", "event_id", "ts")
    folder = new_folder(t.spark, "rate")
    out = f"{folder}/out"
    feeds.limit_rate_in_state(calls, out, f"{folder}/log", "user_id", "ts", "event_id", **RATE)
    return t.spark.read.option("basePath", out).parquet(out).select("user_id", "event_id", "allowed")


@query
def stream_new_matches(t):
    folder = new_folder(t.spark, "matches")
    for _ in range(2):  # the second run finds nothing new
        feeds.load_new_matches(_streamed(t, "matches", "orders"), f"{folder}/out", f"{folder}/log")
    return t.spark.read.parquet(f"{folder}/out")


@query
def stream_dedup(t):
    folder = new_folder(t.spark, "dedup")
    rows = feeds.stream_table(t.spark, t.folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
    )
    once = feeds.drop_repeats(rows, "id", "ts", "30 days").select("id")
    feeds.append_batches(once, f"{folder}/out", f"{folder}/log")
    return t.spark.read.parquet(f"{folder}/out")


@query
def stream_team_counters(t):
    folder = new_folder(t.spark, "counters")
    feeds.count_teams(_streamed(t, "matches", "orders"), f"{folder}/out", f"{folder}/log")
    return feeds.counters_now(t["matches"], f"{folder}/out")


@query
def stream_leaderboard(t):
    folder = new_folder(t.spark, "board")
    players = t["players"]
    earlier = players.withColumn("elo_rating", (4000 - F.col("elo_rating")).cast("int"))
    for version in (earlier, players):  # the second run changes all ratings
        version.write.mode("append").parquet(f"{folder}/in")
        arriving = t.spark.readStream.schema(players.schema).parquet(f"{folder}/in")
        feeds.refresh_leaderboard(arriving, f"{folder}/players", f"{folder}/board", f"{folder}/log")
    return t.spark.read.parquet(f"{folder}/board")


@query
def audit_stream(t):
    folder = new_folder(t.spark, "audit")
    changes = _streamed(t, "player_changes", "events")
    feeds.audit_changes(
        changes, f"{folder}/out", f"{folder}/state", f"{folder}/log", "id", "version", ["elo_rating"], "players"
    )
    return t.spark.read.option("basePath", f"{folder}/out").parquet(f"{folder}/out").drop("batch")


# synthetic tables


def _numbers(t, table: str, key: str) -> DataFrame:
    """One number from 1 per row of a table, to be generated from."""
    return t[table].select((F.col(key) + 1).alias("n"))


@query
def gen_players(t):
    return G.gen_players(_numbers(t, "customer", "c_custkey"), AS_OF)


@query
def gen_teams(t):
    return _plain(G.gen_teams(_numbers(t, "supplier", "s_suppkey")))


@query
def gen_tournaments(t):
    return _plain(G.gen_tournaments(_numbers(t, "part", "p_partkey")))


@query
def gen_rosters(t):
    return G.gen_rosters(t["players"], t["teams"])


@query
def gen_matches(t):
    return G.gen_matches(_numbers(t, "orders", "o_orderkey"), t["tournaments"], t["teams"], AS_OF)


@query
def gen_upcoming_matches(t):
    return G.gen_matches(_numbers(t, "orders", "o_orderkey"), t["tournaments"], t["teams"], AS_OF, upcoming=True)


@query
def gen_player_stats(t):
    return _plain(G.gen_player_stats(t["matches"], t["players"]))


@query
def gen_wide_player_stats(t):
    return _plain(G.gen_player_stats(t["matches"], t["players"], wide=True, groups=2))


@query
def gen_elo_history(t):
    return G.gen_elo_history(t["player_stats"], t["players"], AS_OF)


@query
def gen_bans(t):
    return G.gen_bans(t["players"], AS_OF)


@query
def gen_payouts(t):
    return _plain(G.gen_payouts(t["players"], t["teams"], t["tournaments"], AS_OF))


@query
def named_queries_kept(t):
    root = new_folder(t.spark, "named")
    J.keep_slowest(t.spark, t, root, AS_OF, repeats=1, k=len(J.NAMED_QUERIES))
    sizes = None
    for name in J.NAMED_QUERIES:
        stored = J.named_query(t.spark, t, name, root, AS_OF).agg(F.count(F.lit(1)).alias("n_rows"))
        row = stored.select(F.lit(name).alias("name"), "n_rows")
        sizes = row if sizes is None else sizes.unionByName(row)
    return sizes


# jobs


def _steps(log: DataFrame) -> DataFrame:
    """A run log without its durations."""
    return log.select("job", "step", "position", "status", "n_rows")


@query
def nightly_job(t):
    arriving = _streamed(t, "matches", "orders")
    return _steps(J.nightly(t.spark, t, new_folder(t.spark, "nightly"), AS_OF, readers.FIRST_EXPORT, arriving))


@query
def late_matches(t):
    """The younger matches arrive first; the older ones come later, with some that were there before."""
    folder, matches = new_folder(t.spark, "late"), t["matches"]
    younger = F.col("played_at") >= A.at(WATERMARK)
    for part, moment in ((matches.filter(younger), AS_OF), (matches.filter(~younger | (F.col("id") % 3 == 0)), EVENTS_AS_OF)):
        part.write.mode("append").parquet(f"{folder}/in")
        arriving = t.spark.readStream.schema(matches.schema).parquet(f"{folder}/in")
        J.load_arrivals(t.spark, arriving, folder, moment)
    return t.spark.read.parquet(f"{folder}/new_matches").select(*matches.columns)


@query
def weekly_job(t):
    return _steps(J.weekly(t.spark, t, new_folder(t.spark, "weekly"), AS_OF))


@query
def monthly_job(t):
    return _steps(J.monthly(t.spark, t, MATCH_TABLES, new_folder(t.spark, "monthly"), EVENTS_AS_OF))


@query
def local_export_job(t):
    return _steps(J.local_export(t.spark, t, new_folder(t.spark, "local"), AS_OF, WATERMARK))


@query
def lake_export_job(t):
    return _steps(J.lake_export(t.spark, t, new_folder(t.spark, "lake"), RUN_DATE, limit=None))
