"""The tests declared for the models, run as one report.

Tests of single values are counted in the pass that makes or writes a model. All unique tests share one aggregate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import TOURNAMENT_STATUSES
from .models import write_models

# Model -> column -> tests; a range is (low, high), either may be open
MODEL_TESTS: dict[str, dict[str, dict]] = {
    "stg_players": {"id": {"unique": True, "not_null": True}, "elo_rating": {"range": (0, 4000)}},
    "stg_player_stats": {"stat_id": {"unique": True, "not_null": True}, "headshot_pct": {"range": (0, 100)}},
    "stg_tournaments": {"id": {"unique": True, "not_null": True}, "status": {"values": TOURNAMENT_STATUSES}},
    "stg_matches": {"match_id": {"unique": True, "not_null": True}},
    "stg_teams": {"id": {"unique": True, "not_null": True}},
    "player_performance": {"player_id": {"unique": True, "not_null": True}, "career_kda": {"range": (0, None)}},
    "tournament_standings": {"team_id": {"unique": True}, "total_wins": {"range": (0, None)}},
    "prize_earnings": {"id": {"unique": True}, "prize_pool": {"range": (0, None)}},
}


REPORT = T.StructType(
    [
        T.StructField("model", T.StringType(), False),
        T.StructField("check", T.StringType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("n_violations", T.LongType(), False),
        T.StructField("passed", T.BooleanType(), False),
    ]
)


def single_value_tests(tests: dict[str, dict]) -> list[tuple[str, str, Column]]:
    """(check, column, true where a value breaks it) of the tests that need no other row. NULL passes all but not_null."""
    found = []
    for column, wanted in tests.items():
        if wanted.get("not_null"):
            found.append(("not_null", column, F.col(column).isNull()))
        if "range" in wanted:
            low, high = wanted["range"]
            below = F.col(column) < F.lit(low) if low is not None else F.lit(False)
            above = F.col(column) > F.lit(high) if high is not None else F.lit(False)
            found.append(("accepted_range", column, below | above))
        if "values" in wanted:
            found.append(("accepted_values", column, ~F.col(column).isin(list(wanted["values"]))))
    return [(check, column, F.coalesce(bad, F.lit(False))) for check, column, bad in found]


def unique_columns(tests: dict[str, dict]) -> list[str]:
    return [column for column, wanted in tests.items() if wanted.get("unique")]


def check_models(models, tests: dict[str, dict[str, dict]] | None = None) -> DataFrame:
    """The report over all tested models: one pass over each and one aggregate for all of them.

    A row of a model gives one row per test: the value, for a unique test, or whether a single value is bad. Equal
    ones are added up in the tasks, so what is shuffled is mostly the values that should be unique.
    """
    names, parts = [], []
    for model, wanted in (MODEL_TESTS if tests is None else tests).items():
        rows = []
        for check, column, bad in single_value_tests(wanted):
            rows.append(F.struct(F.lit(len(names)).alias("test"), F.lit(None).cast("string").alias("value"), bad.alias("bad")))
            names.append((model, check, column))
        for column in unique_columns(wanted):
            rows.append(F.struct(F.lit(len(names)).alias("test"), F.col(column).cast("string").alias("value"), F.lit(False).alias("bad")))
            names.append((model, "unique", column))
        parts.append(models[model].select(F.inline(F.array(*rows))))
    values = reduce(DataFrame.unionByName, parts).groupBy("test", "value").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("n_bad"))
    repeated = F.when(F.col("value").isNotNull() & (F.col("n") > 1), 1).otherwise(0)
    counted = values.groupBy("test").agg(F.sum(F.col("n_bad") + repeated).alias("n"))
    # a model without rows leaves no counts: every test is reported from the list, not from what was found
    counts = counted.agg(F.map_from_entries(F.collect_list(F.struct("test", "n"))).alias("found"))
    every = F.array(
        *[F.struct(F.lit(m).alias("model"), F.lit(c).alias("check"), F.lit(col).alias("column_name"), F.lit(at).alias("n_violations")) for at, (m, c, col) in enumerate(names)]
    )
    listed = counts.select("found", F.inline(every))
    return listed.select("model", "check", "column_name", F.coalesce(F.element_at("found", F.col("n_violations")), F.lit(0)).cast("long").alias("n_violations")).withColumn(
        "passed", F.col("n_violations") == 0
    )


def write_tested(tables, target: str, tests: dict[str, dict[str, dict]] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Build all models, write the marts, and test all of them: (models, report).

    Single values of a mart are counted by ``observe`` while it is written, at no further scan.
    """
    tests = MODEL_TESTS if tests is None else tests
    seen: dict[str, Observation] = {}

    def observed(name: str, mart: DataFrame) -> DataFrame:
        found = single_value_tests(tests.get(name, {}))
        if not found:
            return mart
        seen[name] = Observation(name)
        return mart.observe(seen[name], *[F.count_if(bad).alias(f"{check} {column}") for check, column, bad in found])

    models = write_models(tables, target, observed)
    spark = next(iter(models.values())).sparkSession
    rows = []
    for name, observation in seen.items():
        rows += [(name, *test.split(" ", 1), n, n == 0) for test, n in observation.get.items()]
    rest = {
        name: {c: {k: v for k, v in t.items() if name not in seen or k == "unique"} for c, t in wanted.items()} for name, wanted in tests.items()
    }
    rest = {name: wanted for name, wanted in rest.items() if any(wanted.values())}
    report = spark.createDataFrame(rows, REPORT)
    return models, report.unionByName(check_models(models, rest)) if rest else report
