"""Changed rows: audit trail, updates, change logs and their upkeep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import draw_item
from .ranking import first_per_key
from .skew import previous_in_group


def _json(row: Column) -> Column:
    return F.to_json(row, {"ignoreNullFields": "false"})


def audit_diff(before: DataFrame, after: DataFrame, key: str, table_name: str, as_of: str) -> DataFrame:
    """Audit rows between two states of a table: INSERT, UPDATE and DELETE with old and new row as JSON.

    Both states hold each key once, so the join keys are evenly spread. Unchanged rows are dropped by
    a comparison that treats NULL as a value, before any JSON is written.
    """
    columns = [c for c in after.columns if c in before.columns]
    old = before.select(F.col(key).alias("__old_key"), F.struct(*columns).alias("old"))
    new = after.select(F.col(key).alias("__new_key"), F.struct(*columns).alias("new"))
    pairs = old.join(new, F.col("__old_key") == F.col("__new_key"), "full_outer")
    changed = pairs.filter(~F.col("old").eqNullSafe(F.col("new")))
    operation = (
        F.when(F.col("__old_key").isNull(), "INSERT").when(F.col("__new_key").isNull(), "DELETE").otherwise("UPDATE")
    )
    return changed.select(
        F.coalesce("__new_key", "__old_key").alias("row_key"),
        F.lit(table_name).alias("table_name"),
        operation.alias("operation"),
        _json(F.col("old")).alias("old_data"),
        _json(F.col("new")).alias("new_data"),
        F.lit(as_of).cast("timestamp_ntz").alias("changed_at"),
    )


def latest_changes(log: DataFrame, key: str, version: str) -> DataFrame:
    """Newest log row per key. Tasks keep one row per key before the shuffle."""
    return first_per_key(log, [key], [F.desc_nulls_last(version)])


def apply_updates(
    df: DataFrame, updates: DataFrame, key: str, columns: Sequence[str], version: str
) -> tuple[DataFrame, DataFrame]:
    """(table after the updates, updates whose key the table does not have).

    Several updates of one key are applied in version order, so the newest wins.
    """
    newest = latest_changes(updates, key, version).select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    newest = newest.withColumn("__hit", F.lit(True))
    joined = df.join(newest, key, "left")
    shown = [
        F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in df.columns
    ]
    unmatched = newest.join(df.select(key), key, "left_anti")
    return joined.select(*shown), unmatched.select(key, *[F.col(f"__{c}").alias(c) for c in columns])


def shift_rating(players: DataFrame, by: int) -> DataFrame:
    """Bulk update: every rating moved by the same amount."""
    return players.withColumn("elo_rating", F.col("elo_rating") + F.lit(by))


def backfill(df: DataFrame, column: str, values: Sequence[str], key: str) -> DataFrame:
    """Fill a missing column, or its missing values, with a list element chosen by the row's key."""
    current = F.col(column) if column in df.columns else F.lit(None).cast("string")
    return df.withColumn(column, F.coalesce(current, draw_item(values, column, key)))


def changelog_bloat(log: DataFrame, key: str, version: str, threshold: float = 0.15) -> DataFrame:
    """Per operation table: live rows, superseded rows and their share, when above the threshold.

    ``log`` holds several tables told apart by its ``table_name`` column. A key's newest version is
    live unless it is a deletion; every other version is dead.
    """
    per_key = log.groupBy("table_name", key).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(version).alias("last"),
        F.max(F.when(F.col("operation") != "DELETE", F.col(version))).alias("last_kept"),
    )
    live = F.count_if(F.equal_null("last", "last_kept"))
    per_table = per_key.groupBy("table_name").agg(live.alias("live"), F.sum("n").alias("versions"))
    dead = per_table.withColumn("dead", F.col("versions") - F.col("live"))
    share = F.call_function(
        "div", F.col("dead") * 20000 + F.col("versions"), F.nullif(F.col("versions"), F.lit(0)) * 2
    )
    return dead.filter(F.col("dead") > F.lit(threshold) * F.col("live")).select(
        "table_name", "live", "dead", (share.cast("double") / 100).alias("dead_pct")
    )


def changelog_compact(log: DataFrame, key: str, version: str) -> DataFrame:
    """The newest version of every key that is not deleted."""
    return latest_changes(log, key, version).filter(F.col("operation") != "DELETE")


def audit_feed(changes: DataFrame, key: str, version: str, columns: Sequence[str], table_name: str) -> DataFrame:
    """Audit rows of a change feed: the old row is the key's previous change in the feed.

    INSERT shows the new row only, DELETE the old one only, UPDATE both.
    """
    rows = changes.select(
        F.col(key).alias("row_key"), version, "operation", "changed_at", _json(F.struct(key, *columns)).alias("new")
    )
    pairs = previous_in_group(rows, ["row_key"], version, "new", "old")
    return pairs.select(
        "row_key",
        version,
        F.lit(table_name).alias("table_name"),
        "operation",
        F.when(F.col("operation") != "INSERT", F.col("old")).alias("old_data"),
        F.when(F.col("operation") != "DELETE", F.col("new")).alias("new_data"),
        "changed_at",
    )
