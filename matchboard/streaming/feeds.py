"""Streams that start from files, run until they have read what is there, and can be started again.

Progress is the checkpoint's commit log: it moves only after a batch was written, and every sink below
stores a batch that is delivered twice once.

What a stream remembers of its keys is kept by ``KeyedState``. The rate limit's open windows, of which there are
few, are one table, ``batch=N`` of a state folder: batch N reads what batch N-1 left and replaces it; older
states go, as N only starts once N-1 is committed.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import epoch_micros
from ..operators.analytics import MAX_LEADERBOARD, team_counters
from ..operators.changes import audit_feed, latest_changes
from ..operators.ranking import first_per_key
from ..operators.ratelimit import NO_WINDOW, decide_times, rate_limit
from ..operators.skew import skew_join
from ..sources.results import append_new, leaderboard_snapshot
from ..sources.writers import drop_folder, is_file
from .state import KeyedState

# task code travels with the task: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_NEWEST = T.StructType([T.StructField("newest_us", T.LongType())])
_OPEN_WINDOW = [T.StructField("window_end", T.LongType()), T.StructField("calls", T.LongType())]


def stream_table(spark: SparkSession, folder: str, table: str, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet table as a stream of its files; ``table.parquet`` may be a file or a folder."""
    path = f"{folder.rstrip('/')}/{table}.parquet"
    stored = spark.read.parquet(path)
    reader = spark.readStream.schema(stored.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if is_file(spark, path):
        return reader.option("pathGlobFilter", f"{table}.parquet").parquet(folder)
    return reader.parquet(path)


def run_available(df: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append"):
    """Hand everything that is there to ``write`` batch by batch; returns the finished query."""
    query = (
        df.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _state_before(spark: SparkSession, folder: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """What the batch before left; only the first batch may find nothing."""
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/batch={batch_id - 1}")


def _merged(before: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """One row per key: that of ``changed`` where it has one."""
    return changed.unionByName(before.join(changed.select(key), key, "left_anti"))


def _keep_state(state: DataFrame, folder: str, batch_id: int) -> DataFrame:
    path = f"{folder}/batch={batch_id}"
    state.write.mode("overwrite").parquet(path)
    drop_folder(state.sparkSession, f"{folder}/batch={batch_id - 2}")
    return state.sparkSession.read.schema(state.schema).parquet(path)


def load_new_matches(matches: DataFrame, target: str, checkpoint: str, key: str = "id", ts: str = "played_at"):
    """Append matches that arrived since the last run."""
    return run_available(matches, checkpoint, lambda batch, _: append_new(batch, target, key, ts))


def drop_repeats(df: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Rows whose key was not seen within ``delay``. Rows older than the delay are dropped and counted
    by Spark as ``numRowsDroppedByWatermark``, so the delay must cover how late rows may come."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def append_batches(df: DataFrame, target: str, checkpoint: str):
    """Plain file sink with exactly-once commits."""
    query = (
        df.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _counters(df: DataFrame, target: str) -> KeyedState:
    return KeyedState(df.sparkSession, target, "team_id", df.schema)


def count_teams(matches: DataFrame, target: str, checkpoint: str):
    """Running counters per team; a batch replaces those of the teams it changed."""
    return run_available(
        team_counters(matches), checkpoint, lambda changed, batch_id: _counters(changed, target).put(batch_id, changed), "update"
    )


def counters_now(matches: DataFrame, target: str) -> DataFrame:
    """The newest counters of every team, for matches like those counted."""
    state = _counters(team_counters(matches), target)
    return state.rows(state.newest())


def _board_from_changes(state: KeyedState, changed: DataFrame, board: str, batch_id: int) -> DataFrame | None:
    """Players among whom the new leaderboard is, when the stored one and the changes are enough to tell.

    They are if as many of them as the board has places rank no lower than its last place did: everyone else
    ranked below that and has not changed.
    """
    spark = changed.sparkSession
    try:
        last = spark.read.parquet(board).orderBy(F.asc_nulls_first("elo_rating"), F.desc("player_id")).collect()
    except AnalysisException:  # no board yet
        return None
    if not last or last[0].elo_rating is None:
        return None
    kind = dict(changed.dtypes)["id"]
    members = spark.createDataFrame([(r.player_id,) for r in last], "id string").select(F.col("id").cast(kind))
    players = state.rows_of(members.union(changed.select("id")), batch_id)
    if len(last) < MAX_LEADERBOARD:  # all players were on it
        return players
    rating = last[0].elo_rating
    cut = members.sparkSession.createDataFrame([(r.player_id,) for r in last if r.elo_rating == rating], "id string")
    lowest = cut.agg(F.max(F.col("id").cast(kind)).alias("id")).first()["id"]
    no_lower = (F.col("elo_rating") > rating) | ((F.col("elo_rating") == rating) & (F.col("id") <= F.lit(lowest)))
    return players if players.filter(no_lower).count() >= MAX_LEADERBOARD else None


def refresh_leaderboard(players: DataFrame, table: str, board: str, checkpoint: str, version: str = "created_at"):
    """Store new and changed players, then renew the leaderboard.

    A player that comes again replaces the stored one; within a batch the newest ``version`` counts, then the
    higher rating. All players are kept, as one who falls off the board makes room for one below it; they are
    read again only when that happens.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        state = KeyedState(batch.sparkSession, table, "id", batch.schema)
        newest = first_per_key(batch, ["id"], [F.desc_nulls_last(version), F.desc_nulls_last("elo_rating")])
        state.put(batch_id, newest)
        few = _board_from_changes(state, newest, board, batch_id) if batch_id else None
        leaderboard_snapshot(state.rows(batch_id) if few is None else few, board)

    return run_available(players, checkpoint, write)


def audit_changes(
    changes: DataFrame, target: str, state: str, checkpoint: str, key: str, version: str, columns: list[str], name: str
):
    """Audit rows of a change feed. The state folder keeps the newest row per key."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = KeyedState(batch.sparkSession, state, key, batch.schema)
        before = kept.rows_of(batch, batch_id - 1)
        audited = audit_feed(before.unionByName(batch), key, version, columns, name)
        fresh = batch.select(F.col(key).alias("row_key"), version)  # without the earlier rows
        audited.join(fresh, ["row_key", version], "left_semi").write.mode("overwrite").parquet(
            f"{target}/batch={batch_id}"
        )
        kept.put(batch_id, latest_changes(before.unionByName(batch), key, version))

    return run_available(changes, checkpoint, write)


def limit_rate(
    events: DataFrame,
    target: str,
    state: str,
    checkpoint: str,
    key: str,
    ts: str,
    order: str,
    max_calls: int = 100,
    seconds: int = 60,
    lateness: int = 3600,
):
    """Fixed-window rate limit on a stream.

    Each batch goes on from the last windows of its keys, kept in the state folder, and is decided like a
    table: a key that fills a third of a batch is spread over tasks. A window that ended more than
    ``lateness`` seconds before the newest call is dropped.

    Late calls cannot be decided any more, as later ones were: calls from before the key's last window and
    calls older than ``lateness`` when their batch begins. They go whole to ``target-late``, undecided. A call
    without a time is late as well.
    """
    width, slack = seconds * 1_000_000, lateness * 1_000_000

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = _state_before(spark, f"{state}/windows", batch_id, T.StructType([batch.schema[key], *_OPEN_WINDOW]))
        seen = _state_before(spark, f"{state}/newest", batch_id, _NEWEST).agg(F.max("newest_us")).first()[0]
        horizon = F.lit(None if seen is None else seen - slack).cast("long")
        opened = kept.select(key, (F.col("window_end") - width).alias("__opened"))
        timed = skew_join(batch.withColumn("__us", epoch_micros(batch, ts)), opened, [key], "left")
        earliest = F.greatest("__opened", horizon, F.lit(-(2**62)).cast("long"))
        judged = timed.withColumn("__late", F.coalesce(F.col("__us") < earliest, F.lit(True)))
        columns = batch.columns
        judged.filter("__late").select(*columns).write.mode("overwrite").parquet(f"{target}-late/batch={batch_id}")
        batch = judged.filter("NOT __late").select(*columns)
        windows = kept.join(batch.select(key).distinct(), key, "left_semi")
        decided = rate_limit(batch, key, ts, order, max_calls, seconds, open_windows=windows)
        decided.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        written = spark.read.schema(decided.schema).parquet(f"{target}/batch={batch_id}")
        last = first_per_key(written, [key], [F.desc(ts), F.desc(order)])
        every = _merged(kept, last.select(key, "window_end", "calls"), key)
        times = written.select(epoch_micros(written, ts).alias("us")).agg(F.max("us").alias("newest_us"))
        now = _keep_state(times.select(F.greatest("newest_us", F.lit(seen).cast("long")).alias("newest_us")), f"{state}/newest", batch_id)
        newest = now.first()[0]
        still = every if newest is None else every.filter(F.col("window_end") > newest - slack)
        _keep_state(still, f"{state}/windows", batch_id)

    return run_available(events, checkpoint, write)


class _RateWindow(StatefulProcessor):
    """One open window per key: when it ends and how many calls it has seen. A timer drops it when it is over."""

    def __init__(self, max_calls: int, seconds: int, order: str):
        self.max_calls, self.width, self.order = max_calls, seconds * 1_000_000, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", "end long, used long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.window.get() if self.window.exists() else None
        end, used = known or (NO_WINDOW, 0)
        horizon = timerValues.getCurrentWatermarkInMs() * 1000  # zero before any call was seen
        for calls in rows:  # as they come; only one part is held at a time
            calls = calls.sort_values(["call_us", self.order])
            opened = end - self.width if end > NO_WINDOW else NO_WINDOW + 1  # a call without a time is earlier
            late = (calls["call_us"] < max(opened, horizon or opened)).to_numpy()
            times = calls["call_us"].to_numpy()[~late]
            allowed = np.full(len(calls), None, dtype=object)
            if len(times):
                ends, numbers = decide_times(times, end, used, self.width)
                allowed[~late] = numbers <= self.max_calls
                end, used = int(ends[-1]), int(numbers[-1])
            yield calls.drop(columns=["call_us"]).assign(allowed=allowed)
        if (end, used) != (known or (NO_WINDOW, 0)):
            if known and known[0] != end:
                self.handle.deleteTimer(_timer(known[0]))
            self.handle.registerTimer(_timer(end))
            self.window.update((end, used))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.window.clear()
        return iter([])

    def close(self) -> None:
        pass


def _timer(end: int) -> int:
    """The first millisecond at which a window ending at ``end`` microseconds is over."""
    return -(-end // 1000)


def limit_rate_in_state(
    events: DataFrame,
    target: str,
    checkpoint: str,
    key: str,
    ts: str,
    order: str,
    max_calls: int = 100,
    seconds: int = 60,
    lateness: int = 3600,
):
    """The rate limit with windows in Spark's state store, for streams of small micro-batches.

    The state holds a window per key until ``lateness`` seconds after its end; a timer on the calls' time, not the
    clock, then drops it, so the state is bounded by the keys with open windows. A key's calls are decided in the
    parts in which Spark hands them over, each in time order, and none is kept. A key with more calls in a
    micro-batch than an Arrow batch holds (``spark.sql.execution.arrow.maxRecordsPerBatch``) gets several parts;
    a call of a later part that is earlier than the last window is late. Keep micro-batches small with
    ``maxFilesPerTrigger``, or use ``limit_rate`` to work off a backlog or for very busy keys.

    Batches are written to ``target/batch=N``. Late calls, as for ``limit_rate`` (the newest call counts by the
    millisecond), go whole to ``target-late``, undecided.
    """
    spark = events.sparkSession
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    columns = events.columns

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # both parts come from one pass over the state
        late = F.col("allowed").isNull()
        batch.filter(late).select(*columns).write.mode("overwrite").parquet(f"{target}-late/batch={batch_id}")
        batch.filter(~late).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        batch.unpersist()

    spark.conf.set(setting, _ROCKSDB)
    try:
        timed = events.withColumn("call_us", F.coalesce(epoch_micros(events, ts), F.lit(NO_WINDOW)))
        # the watermark follows a copy of the time that goes no further: Spark would drop late rows by it
        seen = timed.withColumn("__seen", F.timestamp_micros(F.greatest("call_us", F.lit(0).cast("long"))))
        watched = seen.withWatermark("__seen", f"{lateness} seconds").drop("__seen")
        schema = T.StructType([*events.schema.fields, T.StructField("allowed", T.BooleanType())])
        decided = watched.groupBy(key).transformWithStateInPandas(
            _RateWindow(max_calls, seconds, order), schema, "Append", "EventTime"
        )
        return run_available(decided, checkpoint, write)
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)
