from matchboard.operators import quality as Q
from matchboard.schema import FOREIGN_KEYS, PRIMARY_KEYS, TABLES

STATS = "id long, match_id long, player_id long, kills int, deaths int, assists int, headshot_pct double"


def test_negative_stats_messages(spark, rows):
    df = spark.createDataFrame([(1, 1, 7, -1, 2, -3, 1.0), (2, 1, 8, None, 0, 0, 1.0)], STATS)
    assert rows(Q.negative_stats(df), "message") == [
        ("Negative assists for player 7: -3",),
        ("Negative kills for player 7: -1",),
    ]


def test_quarantine_follows_check_constraints(spark, rows):
    df = spark.createDataFrame(
        [(1, 1, 1, 0, 0, 0, 0.0), (2, 1, 1, -1, 0, 0, 101.0), (3, 1, 1, None, 0, 0, None)], STATS
    )
    valid, rejected = Q.quarantine(df, Q.stats_rules())
    assert rows(valid, "id") == [(1,), (3,)]
    assert rows(rejected, "id", "broken_rules") == [(2, "kills_not_negative, headshot_pct_0_100")]


def test_reports(spark, rows):
    df = spark.createDataFrame([(1, None), (1, 5), (None, 9), (None, None)], "a int, b int")
    assert rows(Q.not_null(df, ["a", "b"])) == [("not_null", "a", 2), ("not_null", "b", 2)]
    assert rows(Q.unique(df, ["a"])) == [(1, 2)]  # missing keys are not duplicates
    assert rows(Q.accepted_range(df, {"b": (5, 8), "a": (None, 0)})) == [
        ("accepted_range", "a", 2),
        ("accepted_range", "b", 1),
    ]
    assert rows(Q.accepted_values(df, "b", [5])) == [("9", 1)]
    assert rows(Q.singular(df.filter("a > 5"))) == [(0, True)]
    assert rows(Q.singular(df.filter("a = 1"))) == [(2, False)]


def test_foreign_key_reports_values_once(spark, rows):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "team_id int")
    assert rows(Q.foreign_key(child, "team_id", spark.range(1, 2))) == [(2, 2)]


def test_one_active_roster_row(spark, rows):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 9, null), (1, 8, null), (2, 9, DATE'2020-01-01'), (2, 9, null) "
        "AS t(player_id, team_id, left_at)"
    )
    assert rows(Q.active_roster(df)) == [(1, 2)]


def test_new_players(spark, rows):
    df = spark.sql(
        "SELECT * FROM VALUES ('abc', 'UK', DATE'2000-01-01'), ('ab', 'UK', DATE'2000-01-01'), "
        "(repeat('x', 51), 'U', DATE'2000-01-01'), (null, 'UK', null) AS t(username, country, date_of_birth)"
    )
    valid, rejected = Q.validate_new_players(df, "2026-05-17 00:00:00")
    assert rows(valid, "username", "elo_rating") == [("abc", 1200)]
    assert rows(rejected, "broken_rules") == [
        ("username_length",),
        ("username_length, country_length",),
        ("username_length, date_of_birth_given",),
    ]


def test_invalid_utf8_is_found(spark, rows):
    df = spark.sql("SELECT cast(X'61FF' AS string) AS t UNION ALL SELECT 'ok'")
    assert rows(Q.valid_utf8(df, ["t"])) == [("utf8", "t", 1)]


def test_declared_keys_name_declared_columns():
    for table, columns in PRIMARY_KEYS.items():
        assert set(columns) <= set(TABLES[table].names)
    assert len(FOREIGN_KEYS) == 14
    for child, column, parent in FOREIGN_KEYS:
        assert column in TABLES[child].names and "id" in TABLES[parent].names
