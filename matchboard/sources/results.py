"""Stored results: appended loads, results with a time to live, leaderboard snapshots."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..cluster import cut_lineage
from ..operators.analytics import MAX_LEADERBOARD, top_players
from ..operators.changes import apply_updates
from ..operators.ranking import first_per_key
from .keyindex import FEW_KEYS, ROWS_PER_FILE, KeyIndex

REGISTRY = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("computed_at", T.TimestampNTZType()),
        T.StructField("ttl_s", T.LongType()),
    ]
)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, or no rows while nothing has been written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schema)


def new_rows(batch: DataFrame, target: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows of ``batch`` whose key the target lacks, one per key, the newest of the batch.

    The key alone decides: a row delivered again with another time is not stored again.
    """
    known = target.select(key)
    return first_per_key(batch, [key], [F.desc_nulls_last(ts)]).join(known, key, "left_anti")


def append_new(batch: DataFrame, target_path: str, key: str, ts: str) -> int:
    """Append the rows the target does not have yet and return how many. A batch delivered twice is stored once.

    Only files that may hold a key of the batch are read, as the target's key index tells.
    """
    spark = batch.sparkSession
    batch = cut_lineage(first_per_key(batch, [key], [F.desc_nulls_last(ts)]))  # looked at several times
    index = KeyIndex(spark, target_path, key)
    files = index.files_with(batch.select(key))
    known = spark.read.schema(batch.schema).parquet(*files) if files else spark.createDataFrame([], batch.schema)
    fresh = cut_lineage(batch.join(known.select(key), key, "left_anti"))
    stored = fresh.count()
    if 0 < stored <= FEW_KEYS:
        fresh = fresh.coalesce(1)  # one file, and no empty one beside it
    if stored or not files:  # an empty first batch still makes the table
        fresh.write.mode("append").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(target_path)
        index.refresh()
    return stored


def as_new_matches(matches: DataFrame, loaded_at: str) -> DataFrame:
    """Match rows in the shape of the load table: ``created_by`` may be missing, load time added."""
    if "created_by" not in matches.columns:
        matches = matches.withColumn("created_by", F.lit(None).cast("string"))
    return matches.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp_ntz"))


class ResultStore:
    """Named results as Parquet below one folder, each valid for a number of seconds."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def registry(self) -> DataFrame:
        """One row per stored result."""
        return read_or_empty(self.spark, f"{self.root}/_entries", REGISTRY)

    def valid(self, name: str, as_of: str) -> DataFrame | None:
        """The newest stored result of that name that has not expired."""
        live = self.registry().filter((F.col("name") == name)).transform(mark_expired, as_of).filter("NOT expired")
        newest = live.orderBy(F.desc("computed_at")).limit(1).collect()
        return self.spark.read.parquet(newest[0]["path"]) if newest else None

    def put(self, name: str, df: DataFrame, ttl_s: int, as_of: str) -> DataFrame:
        """Store a result; an empty one keeps its columns. It counts only once completely written."""
        moment = datetime.fromisoformat(as_of)
        path = f"{self.root}/{name}/{moment:%Y%m%d%H%M%S}"
        df.write.mode("overwrite").parquet(path)
        entry = self.spark.createDataFrame([(name, path, moment, ttl_s)], REGISTRY)
        entry.coalesce(1).write.mode("append").parquet(f"{self.root}/_entries")
        return self.spark.read.parquet(path)

    def cached_query(self, name: str, build: Callable[[], DataFrame], ttl_s: int, as_of: str) -> DataFrame:
        """The stored result while it is valid, else the query's result, stored now."""
        stored = self.valid(name, as_of)
        return stored if stored is not None else self.put(name, build(), ttl_s, as_of)


def mark_expired(registry: DataFrame, as_of: str) -> DataFrame:
    """Registry rows with the end of their validity and whether it has passed."""
    ends = F.col("computed_at") + F.make_dt_interval(secs=F.col("ttl_s").cast("decimal(18,6)"))
    return registry.withColumn("expires_at", ends).withColumn(
        "expired", F.col("expires_at") <= F.lit(as_of).cast("timestamp_ntz")
    )


def leaderboard_rows(players: DataFrame, size: int = MAX_LEADERBOARD) -> DataFrame:
    """The rows of a leaderboard snapshot."""
    return top_players(players, size).select(
        F.col("id").cast("string").alias("player_id"),
        F.col("elo_rating").cast("long").alias("elo_rating"),
        "username",
        F.coalesce("country", F.lit("")).alias("country"),
    )


def leaderboard_snapshot(players: DataFrame, path: str, size: int = MAX_LEADERBOARD) -> DataFrame:
    """Replace the stored leaderboard and return it."""
    leaderboard_rows(players, size).write.mode("overwrite").parquet(path)
    return players.sparkSession.read.parquet(path)


def write_through(
    players: DataFrame, updates: DataFrame, version: str, board: str, size: int = MAX_LEADERBOARD
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(players with new ratings, leaderboard built from just those, updates of unknown players).

    Table and leaderboard come from one written copy, so they always agree.
    """
    updated, unmatched = apply_updates(players, updates, "id", ["elo_rating"], version)
    updated = cut_lineage(updated)
    return updated, leaderboard_snapshot(updated, board, size), unmatched
