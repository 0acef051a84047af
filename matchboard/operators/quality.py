"""Data checks. Each returns violating values or a (check, column, violations) report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import FOREIGN_KEYS


def _report(df: DataFrame, check: str, violations: dict[str, Column]) -> DataFrame:
    """One pass over the table, then one row per checked column."""
    counted = df.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(c) for c, bad in violations.items()])
    rows = F.array(
        *[
            F.struct(F.lit(check).alias("check"), F.lit(c).alias("column_name"), F.col(c).alias("n_violations"))
            for c in violations
        ]
    )
    return counted.select(F.inline(rows))


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values per column."""
    return _report(df, "not_null", {c: F.col(c).isNull() for c in columns})


def accepted_range(df: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    """Values outside [low, high] per column; either bound may be None. NULL passes."""
    bad = {}
    for column, (low, high) in ranges.items():
        below = F.col(column) < F.lit(low) if low is not None else F.lit(False)
        above = F.col(column) > F.lit(high) if high is not None else F.lit(False)
        bad[column] = below | above
    return _report(df, "accepted_range", bad)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their row count. NULL passes."""
    outside = df.filter(~F.col(column).isin(list(values)))
    return outside.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once. A key with a missing part is left to ``not_null``."""
    keyed = df.dropna(subset=list(columns))
    return keyed.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def active_roster(rosters: DataFrame) -> DataFrame:
    """Players with more than one roster row that has not ended."""
    return unique(rosters.filter(F.col("left_at").isNull()), ["player_id"])


def foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_key: str = "id") -> DataFrame:
    """Child values without a parent row, with their row count.

    Rows are counted per value first, so a value that fills a third of the table is one row in the join.
    """
    used = child.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(F.col(parent_key).alias("value"))
    return used.filter(F.col("value").isNotNull()).join(known, "value", "left_anti")


_KEY = -1  # in place of a reference's number: the row is a parent's key


def foreign_keys(tables, references=FOREIGN_KEYS) -> DataFrame:
    """All declared references: one row per value without a parent.

    Every table is read once, for its own keys and for all its references, and no join is needed: rows are counted
    per parent and value, in the tasks first, and a value that is no key of its parent is an orphan.
    """
    parts = None
    for name in dict.fromkeys([r[0] for r in references] + [r[2] for r in references]):
        seen = [(parent, at, column) for at, (child, column, parent) in enumerate(references) if child == name]
        if any(parent == name for _, _, parent in references):
            seen.append((name, _KEY, "id"))
        rows = [
            F.struct(F.lit(parent).alias("parent_table"), F.lit(at).alias("at"), F.col(column).cast("string").alias("value"))
            for parent, at, column in seen
        ]
        part = tables[name].select(F.inline(F.array(*rows)))
        parts = part if parts is None else parts.unionByName(part)
    counts = parts.filter(F.col("value").isNotNull()).groupBy("parent_table", "value").agg(
        F.max(F.col("at") == _KEY).alias("known"), *[F.count_if(F.col("at") == at).alias(f"n{at}") for at in range(len(references))]
    )
    found = [
        F.struct(F.lit(child).alias("child_table"), F.lit(column).alias("column_name"), F.lit(parent).alias("parent"), F.col(f"n{at}").alias("n_rows"))
        for at, (child, column, parent) in enumerate(references)
    ]
    orphans = counts.filter(~F.col("known")).select("parent_table", "value", F.inline(F.array(*found)))
    return orphans.filter("n_rows > 0 AND parent = parent_table").select("child_table", "column_name", "parent_table", "value", "n_rows")


def singular(violating: DataFrame) -> DataFrame:
    """A check stated as a query that must return no rows."""
    return violating.agg(F.count(F.lit(1)).alias("n_violations")).withColumn("passed", F.col("n_violations") == 0)


def negative_stats(stats: DataFrame) -> DataFrame:
    """One message per negative kills, assists or deaths value; missing values pass."""
    messages = F.array(
        *[
            F.when(
                F.col(c) < 0,
                F.concat(F.lit(f"Negative {c} for player "), F.col("player_id").cast("string"), F.lit(": "), F.col(c)),
            )
            for c in ("kills", "assists", "deaths")
        ]
    )
    # rows without a finding are dropped before the list is taken apart
    wrong = stats.filter("kills < 0 OR assists < 0 OR deaths < 0")
    return wrong.select("player_id", F.explode(F.array_compact(messages)).alias("message"))


def judge(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """All rows with the names of the rules they break; NULL for a valid row.

    As for a CHECK constraint, a rule that gives NULL is not broken.
    """
    names = [F.when(~rule, F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("broken_rules", F.nullif(F.concat_ws(", ", *names), F.lit("")))


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split into (valid rows, rejected rows with the names of the rules they break)."""
    kept = F.lit(True)
    for rule in rules.values():
        kept = kept & F.coalesce(rule, F.lit(True))
    return df.filter(kept), judge(df.filter(~kept), rules)


def stats_rules() -> dict[str, Column]:
    """CHECK constraints of player_stats."""
    rules = {f"{c}_not_negative": F.col(c) >= 0 for c in ("kills", "deaths", "assists")}
    return {**rules, "headshot_pct_0_100": F.col("headshot_pct").between(0, 100)}


def new_player_rules() -> dict[str, Column]:
    """Length bounds on name and country of a new player; all three values must be given."""
    return {
        "username_length": F.coalesce(F.char_length("username").between(3, 50), F.lit(False)),
        "country_length": F.coalesce(F.char_length("country").between(2, 60), F.lit(False)),
        "date_of_birth_given": F.col("date_of_birth").isNotNull(),
    }


def judge_new_players(candidates: DataFrame, as_of: str) -> DataFrame:
    """New player rows with the rules they break. Valid ones start now at rating 1200."""
    judged = judge(candidates, new_player_rules())
    valid = F.col("broken_rules").isNull()
    return judged.withColumn("elo_rating", F.when(valid, F.lit(1200))).withColumn(
        "created_at", F.when(valid, F.lit(as_of).cast("timestamp_ntz"))
    )


def validate_new_players(candidates: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame]:
    """(rows to add, rejected rows with the rules they break)."""
    judged = judge_new_players(candidates, as_of)
    accepted = judged.filter(F.col("broken_rules").isNull()).drop("broken_rules")
    return accepted, judged.filter(F.col("broken_rules").isNotNull()).drop("elo_rating", "created_at")


def valid_utf8(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values per column that are not valid UTF-8."""
    return _report(df, "utf8", {c: ~F.is_valid_utf8(c) for c in columns})
