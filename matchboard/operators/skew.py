"""Hot groups: find them, spread them over tasks, keep the result exact.

Plain aggregates need none of this: Spark combines them before the shuffle. It is for joins and
ordered windows, which move every row of a group to one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..cluster import cut_lineage, fits

HOT_ROWS = 2_000_000  # a group below this is no problem for one task
MAX_HOT = 100_000  # a bound of the list of hot groups: beyond 200 billion rows, HOT_ROWS grows with the table
SAMPLED_ROWS = 500  # rows of the smallest hot group to expect in the sample
BROADCAST_ROWS = 200_000  # lookups up to here are broadcast: some ten MB
SEGMENT_ROWS = 1_000_000

SEGMENT = "__segment"
_SALT = "__salt"
_TURN = "__turn"
_HOT = "__hot"
_PARTS = "__parts"


@dataclass(frozen=True)
class HotGroup:
    """Key values of a group that is too large for one task, with its estimated rows."""

    key: tuple
    rows: int


def hot_groups(
    df: DataFrame, keys: Sequence[str], min_rows: int = HOT_ROWS, total: int | None = None
) -> list[HotGroup]:
    """Groups of more than ``min_rows`` rows, whatever share of all rows that is.

    Only the key columns are sampled, densely enough that such a group shows with some ``SAMPLED_ROWS`` rows. A
    frame with fewer than ``min_rows`` rows costs one count. The list has at most ``MAX_HOT`` entries or so, as
    ``min_rows`` is at least the ``MAX_HOT``-th part of the table. The sample decides how work is spread, never
    what the result is.
    """
    total = df.count() if total is None else total
    if total <= min_rows:
        return []
    min_rows = max(min_rows, total // MAX_HOT)
    fraction = min(1.0, SAMPLED_ROWS / min_rows)
    keyed = df.select(*keys)
    sample = keyed if fraction == 1.0 else keyed.sample(fraction, seed=17)
    least = min_rows * fraction * (1.0 if fraction == 1.0 else 0.8)  # room for chance
    found = sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > least)
    return [HotGroup(tuple(row[k] for k in keys), int(row["n"] / fraction)) for row in found.collect()]


def _hot_frame(df: DataFrame, keys: Sequence[str], hot: Sequence[HotGroup], min_rows: int = HOT_ROWS) -> DataFrame:
    """The keys of the hot groups and into how many parts each is cut; at most ``MAX_HOT`` rows or so."""
    fields = [T.StructField(f"{_HOT}{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    rows = [(*group.key, max(2, -(-group.rows // min_rows))) for group in hot]
    return F.broadcast(df.sparkSession.createDataFrame(rows, T.StructType([*fields, T.StructField(_PARTS, T.LongType())])))


def _same_key(keys: Sequence[str]) -> Column:
    """Condition of a join with ``_hot_frame``; NULL equals NULL."""
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"{_HOT}{i}")) for i, k in enumerate(keys)])


def only_hot(df: DataFrame, keys: Sequence[str], hot: Sequence[HotGroup]) -> DataFrame:
    """Rows of the hot groups."""
    return df.join(_hot_frame(df, keys, hot), _same_key(keys), "left_semi") if hot else df.filter(F.lit(False))


def without_hot(df: DataFrame, keys: Sequence[str], hot: Sequence[HotGroup]) -> DataFrame:
    """Rows of all other groups."""
    return df.join(_hot_frame(df, keys, hot), _same_key(keys), "left_anti") if hot else df


@dataclass(frozen=True)
class Lookup:
    """One side of ``skew_joins``: a frame with one row per key."""

    frame: DataFrame
    keys: tuple[str, ...]
    how: str = "inner"


def skew_joins(
    facts: DataFrame, lookups: Sequence[Lookup], min_rows: int = HOT_ROWS, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Join each fact to its row in every lookup without gathering a hot key in one task.

    A lookup of at most ``broadcast_rows`` rows, counted here, is broadcast and the facts stay where they
    are. For a larger one both sides shuffle; then facts of hot keys carry a salt, and the lookup rows of
    those keys are repeated once per salt: as many as parts of ``min_rows`` rows need. Salts count rows of
    the scan, before any shuffle, so a retried task deals them out the same way; facts must come straight
    from a scan or written table.
    """
    small = [fits(lookup.frame, broadcast_rows) for lookup in lookups]
    total = 0 if all(small) else facts.count()
    hot = [[] if few else hot_groups(facts, lookup.keys, min_rows, total) for lookup, few in zip(lookups, small)]
    joined = facts.withColumn(_TURN, F.monotonically_increasing_id()) if any(hot) else facts
    for i, lookup in enumerate(lookups):
        frame, keys, salt = lookup.frame, list(lookup.keys), f"{_SALT}{i}"
        if small[i]:
            frame = F.broadcast(frame)
        if hot[i]:
            parts = _hot_frame(facts, keys, hot[i], min_rows)
            names = [f"{_HOT}{k}" for k in range(len(keys))] + [_PARTS]
            joined = joined.join(parts, _same_key(keys), "left")
            joined = joined.withColumn(salt, F.coalesce(F.pmod(_TURN, _PARTS), F.lit(0).cast("long"))).drop(*names)
            copies = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(_PARTS), F.lit(1)) - 1)
            frame = frame.join(parts, _same_key(keys), "left").withColumn(salt, F.explode(copies)).drop(*names)
            keys = [*keys, salt]
        joined = joined.join(frame, keys, lookup.how)
    return joined.drop(_TURN, *[f"{_SALT}{i}" for i in range(len(lookups))])


def skew_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    min_rows: int = HOT_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``skew_joins`` with one lookup."""
    return skew_joins(facts, [Lookup(lookup, tuple(keys), how)], min_rows, broadcast_rows)


def piece_count(hot: Sequence[HotGroup], rows_per_piece: int = SEGMENT_ROWS) -> int:
    """Into how many pieces to cut the rows of the hot groups."""
    return max(2, -(-sum(group.rows for group in hot) // rows_per_piece))


def range_pieces(df: DataFrame, order: Sequence[Column], pieces: int, name: str) -> DataFrame:
    """Cut rows into about equally large ranges of ``order``, numbered in that order.

    Spark finds the ranges from a sample, whatever the values look like. The result is written once, so
    that a row keeps its piece however often the result is read. Rows equal in ``order`` stay together.
    """
    return cut_lineage(df.repartitionByRange(pieces, *order)).withColumn(name, F.spark_partition_id())


def add_segment(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    hot: Sequence[HotGroup],
    rows_per_segment: int = SEGMENT_ROWS,
) -> DataFrame:
    """Cut hot groups into ranges of ``order``; every other group is one piece, number 0."""
    if not hot:
        return df.withColumn(SEGMENT, F.lit(0))
    pieces = piece_count(hot, rows_per_segment)
    sorting = [*[F.asc(k) for k in keys], *[F.asc_nulls_last(c) for c in order]]
    cut = range_pieces(only_hot(df, keys, hot), sorting, pieces, SEGMENT)
    return without_hot(df, keys, hot).withColumn(SEGMENT, F.lit(0)).unionByName(cut)


def add_offsets(
    df: DataFrame, keys: Sequence[str], totals: dict[str, Column], hot: Sequence[HotGroup]
) -> DataFrame:
    """For rows cut by ``add_segment``: the totals over all earlier pieces of the row's group.

    ``totals`` maps new column names to aggregates. Only hot groups have earlier pieces. A piece holds
    ranges of one group or of neighbours, so there are at most as many as pieces and hot groups together:
    one per million rows, which bounds the broadcast.
    """
    keys = list(keys)
    if not hot:
        return df.select("*", *[F.lit(0).alias(name) for name in totals])
    per_piece = (
        only_hot(df, keys, hot).groupBy(*keys, SEGMENT).agg(*[agg.alias(name) for name, agg in totals.items()])
    )
    before = W.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(W.unboundedPreceding, -1)
    offsets = per_piece.select(
        *[F.col(k).alias(f"__{k}") for k in [*keys, SEGMENT]],
        *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"__{name}") for name in totals],
    )
    joined = df.alias("l").join(
        F.broadcast(offsets), [F.col(f"l.{k}").eqNullSafe(F.col(f"__{k}")) for k in [*keys, SEGMENT]], "left"
    )
    return joined.select(
        *df.columns, *[F.coalesce(F.col(f"__{name}"), F.lit(0)).alias(name) for name in totals]
    )


def position_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, hot: Sequence[HotGroup] | None = None
) -> DataFrame:
    """Number the rows of each group 1, 2, ... by ascending ``order``; hot groups are numbered in pieces."""
    keys = list(keys)
    hot = hot_groups(df, keys) if hot is None else hot
    cut = add_segment(df, keys, order, hot)
    counted = add_offsets(cut, keys, {"__before": F.count(F.lit(1))}, hot)
    local = F.row_number().over(W.partitionBy(*keys, SEGMENT).orderBy(*[F.asc_nulls_last(c) for c in order]))
    return counted.withColumn(name, (local + F.col("__before")).cast("long")).drop("__before", SEGMENT)


def previous_in_group(
    df: DataFrame, keys: Sequence[str], order: str, value: str, name: str, hot: Sequence[HotGroup] | None = None
) -> DataFrame:
    """Add the ``value`` of the row before, by ascending ``order``, in the same group.

    In a hot group the first row of a piece takes the last value of the nearest earlier piece.
    """
    keys = list(keys)
    hot = hot_groups(df, keys) if hot is None else hot
    cut = add_segment(df, keys, [order], hot)
    within = W.partitionBy(*keys, SEGMENT).orderBy(F.asc_nulls_last(order))
    lagged = cut.withColumn(name, F.lag(value).over(within))
    if not hot:
        return lagged.drop(SEGMENT)
    lagged = lagged.withColumn("__first", F.row_number().over(within) == 1)
    last = only_hot(cut, keys, hot).groupBy(*keys, SEGMENT).agg(F.max_by(value, order).alias("__last"))
    pieces = W.partitionBy(*keys).orderBy(SEGMENT)
    carried = last.select(  # one row per piece and hot group
        *[F.col(k).alias(f"__{k}") for k in [*keys, SEGMENT]], F.lag("__last").over(pieces).alias("__carried")
    )
    joined = lagged.alias("l").join(
        F.broadcast(carried), [F.col(f"l.{k}").eqNullSafe(F.col(f"__{k}")) for k in [*keys, SEGMENT]], "left"
    )
    return joined.select(
        *df.columns, F.when(F.col("__first"), F.col("__carried")).otherwise(F.col(name)).alias(name)
    )
