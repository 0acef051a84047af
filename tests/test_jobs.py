import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchboard.cluster import cut_lineage

from matchboard.plans import jobs as J
from matchboard.operators import quality
from matchboard.plans.checks import MODEL_TESTS, check_models, write_tested
from matchboard.plans.models import MARTS, VIEWS, Models, build_models, write_models
from matchboard.schema import FOREIGN_KEYS, TABLES
from matchboard.sources import readers, results
from matchboard.sources.fixtures import AS_OF


def test_a_failing_step_stops_the_job(spark):
    def fail():
        raise RuntimeError("no such table\nsecond line")

    log = J.run_steps(spark, "j", [("a", lambda: 3), ("b", fail), ("c", lambda: 1)]).orderBy("position").collect()
    steps = [(r["step"], r["status"], r["n_rows"]) for r in log]
    assert steps == [("a", "ok", 3), ("b", "failed", None), ("c", "skipped", None)]
    assert log[1]["message"] == "no such table"
    summary = J.run_log_summary(spark.createDataFrame(log)).collect()
    assert {r["query_name"] for r in summary} == {"a", "b", "c"}


def test_second_nightly_load_finds_nothing(spark, tables, tmp_path):
    root = str(tmp_path)
    first = J.load_matches(spark, tables["matches"], root, AS_OF, readers.FIRST_EXPORT)
    assert first > 0
    assert J.load_matches(spark, tables["matches"], root, AS_OF, readers.FIRST_EXPORT) == 0
    assert spark.read.parquet(f"{root}/new_matches").count() == first


def test_default_first_load_is_after_these_matches(spark, tables, tmp_path):
    assert J.load_matches(spark, tables["matches"], str(tmp_path), AS_OF) == 0


def test_all_models_are_built(spark, tables, tmp_path, rows):
    built = write_models(tables, str(tmp_path))
    assert list(built) == [*VIEWS, *MARTS]
    lazy = Models(tables)
    for name in MARTS:
        assert rows(spark.read.parquet(str(tmp_path / name))) == rows(lazy[name])


def test_lake_export_works_models_out_once(spark, tables, tmp_path):
    class Changing:
        def __getitem__(self, name):
            other = F.udf(lambda: uuid.uuid4().hex).asNondeterministic()
            return tables[name].withColumn("username", other()) if name == "players" else tables[name]

    base = f"{tmp_path}/int_player_match_summary"
    for date in ("2026-05-07", "2026-05-17", "2026-05-17"):
        log = J.lake_export(spark, Changing(), str(tmp_path), date).collect()
        assert {r["status"] for r in log} == {"ok"}
        held = spark.read.parquet(f"{base}/parquet/year=2026/month=05/day={date[-2:]}")
        copied = spark.read.option("header", True).csv(f"{base}/csv/year=2026/month=05/day={date[-2:]}")
        names = {(r.stat_id, r.username) for r in held.select(F.col("stat_id").cast("string"), "username").collect()}
        assert copied.columns == held.columns and copied.count() == held.count() == tables["player_stats"].count()
        assert names == {(r.stat_id, r.username) for r in copied.select("stat_id", "username").collect()}


def test_lake_export_goes_on_after_a_failure(spark, tables, tmp_path):
    class Broken:
        def __getitem__(self, name):
            if name == "player_stats":
                raise KeyError(name)
            return tables[name]

    log = {r["step"]: r["status"] for r in J.lake_export(spark, Broken(), str(tmp_path), "2026-05-17").collect()}
    assert log["int_player_match_summary"] == "failed"
    assert log["int_team_match_summary"] == log["tournament_standings"] == "ok"


def test_named_queries_are_kept(spark, tables, tmp_path):
    root = str(tmp_path)
    log = J.keep_slowest(spark, tables, root, AS_OF, repeats=1, k=2)
    assert log.count() == 8 and log.filter("status <> 'ok'").count() == 0
    assert results.ResultStore(spark, f"{root}/results").registry().count() == 2
    assert J.named_query(spark, tables, "Top_Elo_Players", root, AS_OF).count() == 10
    with pytest.raises(KeyError):
        J.named_query(spark, tables, "nothing", root, AS_OF)


def test_table_and_leaderboard_agree(spark, tmp_path, rows):
    columns = "id long, username string, country string, elo_rating int"
    players = spark.createDataFrame([(1, "a", "X", 10), (2, "b", "Y", 20)], columns)
    updates = spark.createDataFrame([(1, 1, 99), (7, 1, 5)], "id long, v long, elo_rating int")
    updated, board, unmatched = results.write_through(players, updates, "v", str(tmp_path / "b"))
    assert rows(updated, "id", "elo_rating") == [(1, 99), (2, 20)]
    assert rows(board, "player_id", "elo_rating") == [("1", 99), ("2", 20)]
    assert rows(unmatched, "id") == [(7,)]


def test_model_report_names_what_fails(spark, rows):
    stats = spark.createDataFrame([(1, 50.0), (1, 101.0), (None, 5.0)], "stat_id long, headshot_pct double")
    assert rows(check_models({"m": stats}, {"m": MODEL_TESTS["stg_player_stats"]})) == [
        ("m", "accepted_range", "headshot_pct", 1, False),
        ("m", "not_null", "stat_id", 1, False),
        ("m", "unique", "stat_id", 1, False),
    ]
    assert sum(len(tests) for columns in MODEL_TESTS.values() for tests in columns.values()) == 20


def test_checks_while_writing(spark, tables, tmp_path, rows):
    """The report of observed writes is that of the checks, also where something is wrong."""
    tests = {
        **MODEL_TESTS,
        "player_performance": {"player_id": {"unique": True, "not_null": True}, "career_kda": {"range": (1, 2)}, "username": {"values": ["nobody"]}},
        "country_leaderboard": {"team_id": {"unique": True}, "total_wins": {"unique": True}},
    }
    models, report = write_tested(tables, str(tmp_path), tests)
    got = rows(report)
    assert got == rows(check_models(Models(tables), tests))
    assert sum(not r[-1] for r in got) >= 2 and len(got) == sum(len(t) for m in tests.values() for t in m.values())
    assert {m: models[m].count() for m in MARTS} == {m: Models(tables)[m].count() for m in MARTS}


def test_checks_of_empty_and_repeated_values(spark, rows):
    wanted = {"m": {"a": {"unique": True, "not_null": True}, "b": {"range": (0, 5), "values": [1, 2]}}}
    frame = spark.createDataFrame([(1, 1), (1, 9), (None, None), (None, -1), (2, 2), (2, 2), (2, 2)], "a int, b int")
    expected = [("m", "accepted_range", "b", 2, False), ("m", "accepted_values", "b", 2, False), ("m", "not_null", "a", 2, False), ("m", "unique", "a", 2, False)]
    assert rows(check_models({"m": frame}, wanted)) == expected
    assert rows(check_models({"m": frame.limit(0)}, wanted)) == [(*r[:3], 0, True) for r in expected]


def test_foreign_keys_take_one_shuffle(spark):
    folder = {n: spark.createDataFrame([], TABLES[n]) for n in {t for r in FOREIGN_KEYS for t in (r[0], r[2])}}
    plan = quality.foreign_keys(folder)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") <= 1


def test_late_matches_are_loaded_once(spark, tables, tmp_path):
    root, schema = str(tmp_path), tables["matches"].schema
    matches = tables["matches"].limit(60).orderBy("played_at", "id").collect()

    def arrive(rows, moment):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        return J.load_arrivals(spark, spark.readStream.schema(schema).parquet(f"{root}/in"), root, moment, readers.FIRST_EXPORT)

    def watermark():
        return readers.watermark_state(spark.read.parquet(f"{root}/watermarks"), readers.FIRST_EXPORT).first()[0]

    assert arrive(matches[30:], "2026-05-01 00:00:00") == 30
    newest = watermark()
    assert newest == matches[-1]["played_at"]
    assert arrive(matches[:20] + matches[40:], "2026-05-02 00:00:00") == 20  # older than the watermark, the rest known
    assert arrive([], "2026-05-03 00:00:00") == 0 and watermark() == newest
    stored = spark.read.parquet(f"{root}/new_matches")
    assert sorted(r.id for r in stored.collect()) == sorted(m.id for m in matches[:20] + matches[30:])
    copies = sorted(p.name for p in (tmp_path / "lake").iterdir())
    columns = [f for f in stored.schema.fields if f.name != "loaded_at"]
    counts = [readers.read_csv(spark, f"{root}/lake/{c}", T.StructType(columns)).count() for c in copies]
    assert counts == [30, 20]


def test_load_counts_what_it_stores(spark, tables, tmp_path):
    matches = tables["matches"].limit(50)
    results.append_new(results.as_new_matches(matches.limit(20), AS_OF), f"{tmp_path}/new_matches", "id", "played_at")
    assert J.load_matches(spark, cut_lineage(matches), str(tmp_path), "2026-06-01 00:00:00", readers.FIRST_EXPORT) >= 30
