"""Top-k, ranks and row numbers that never sort the whole table in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..cluster import cut_lineage, fits
from .skew import range_pieces, skew_join

_LOCAL_ROW_BITS = 33  # monotonically_increasing_id keeps the partition number above these bits
_RANK_PIECES = 1000
FEW_ROWS = 100_000
FEW_SCORES = 200_000


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows by a total order: each task keeps k rows, the driver side merges them."""
    return df.orderBy(*order).limit(k)


def top_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str = "rnk"
) -> DataFrame:
    """First ``n`` rows of each key with their position.

    The filter on ``row_number`` lets Spark cut every map task to n rows per key before the shuffle,
    so a hot key sends n rows per task and no more.
    """
    numbered = df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return numbered.filter(F.col(name) <= n)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The one row per key that comes first."""
    return top_n_per_key(df, keys, order, 1, "__first").drop("__first")


def rank_top(df: DataFrame, score: str, k: int, kind: str, tie: Sequence[Column], name: str = "rank") -> DataFrame:
    """``k`` best rows with their rank. The ranks of the first k rows do not depend on later rows."""
    best = top_k(df, [F.desc_nulls_last(score), *tie], k)
    window = W.orderBy(F.desc_nulls_last(score))  # over at most k rows
    rank = {"rank": F.rank(), "dense": F.dense_rank()}[kind]
    return best.withColumn(name, rank.over(window).cast("long"))


def rank_by_score(df: DataFrame, score: str, kind: str = "rank", name: str = "rank") -> DataFrame:
    """Rank of every row by descending score (NULL last), without a window over the whole table.

    A frame of few rows takes that window all the same. Otherwise rows are first counted per distinct
    score and the counts written once. Few scores (ratings have at most 4001) are ranked in one small
    window and broadcast. Many are cut into ranges: a rank is the count in better ranges plus the count of
    better scores in the same range.
    """
    if kind not in ("rank", "dense"):
        raise ValueError(f"kind must be 'rank' or 'dense', not {kind!r}")
    if fits(df, FEW_ROWS):
        function = F.rank() if kind == "rank" else F.dense_rank()
        return df.withColumn(name, function.over(W.orderBy(F.desc_nulls_last(score))).cast("long"))
    keyed = df.withColumn("__missing", F.col(score).isNull()).withColumn(
        "__score", F.coalesce(F.col(score), F.lit(0).cast(df.schema[score].dataType))
    )
    keys = ["__missing", "__score"]
    counts = cut_lineage(keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")))
    few = fits(counts, FEW_SCORES)
    ranks = (_rank_scores if few else _rank_many_scores)(counts, kind, name).select(*keys, name)
    joined = keyed.join(F.broadcast(ranks), keys) if few else skew_join(keyed, ranks, keys, broadcast_rows=0)
    return joined.select(*df.columns, name)


def _rank_scores(counts: DataFrame, kind: str, name: str) -> DataFrame:
    best_first = W.orderBy(F.asc("__missing"), F.desc("__score"))  # over at most FEW_SCORES rows
    above = F.coalesce(F.sum("__n").over(best_first.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + 1
    return counts.withColumn(name, (above if kind == "rank" else F.row_number().over(best_first)).cast("long"))


def _rank_many_scores(counts: DataFrame, kind: str, name: str) -> DataFrame:
    best_first = [F.asc("__missing"), F.desc("__score")]
    counts = range_pieces(counts, best_first, _RANK_PIECES, "__piece")
    better_pieces = W.orderBy("__piece").rowsBetween(W.unboundedPreceding, -1)
    pieces = (
        counts.groupBy("__piece")  # at most _RANK_PIECES rows
        .agg(F.sum("__n").alias("rows"), F.count(F.lit(1)).alias("scores"))
        .select(
            "__piece",
            F.coalesce(F.sum("rows").over(better_pieces), F.lit(0)).alias("__rows_above"),
            F.coalesce(F.sum("scores").over(better_pieces), F.lit(0)).alias("__scores_above"),
        )
    )
    same_piece = W.partitionBy("__piece").orderBy(*best_first)
    better_here = same_piece.rowsBetween(W.unboundedPreceding, -1)
    if kind == "rank":
        place = F.col("__rows_above") + F.coalesce(F.sum("__n").over(better_here), F.lit(0)) + 1
    else:
        place = F.col("__scores_above") + F.row_number().over(same_piece)
    return counts.join(F.broadcast(pieces), "__piece").withColumn(name, place.cast("long"))


def zip_with_index(df: DataFrame, order: Sequence[Column], name: str = "rn", start: int = 1) -> DataFrame:
    """Number all rows start, start + 1, ... in the given total order.

    Rows are range partitioned, sorted and written once; a partition's first number is the row count of
    the partitions before it. The written copy keeps both reads of it identical.
    """
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = cut_lineage(sorted_rows).withColumn("__at", F.monotonically_increasing_id())
    kept = kept.withColumn("__part", F.shiftright("__at", _LOCAL_ROW_BITS)).withColumn(
        "__row", F.col("__at").bitwiseAND(F.lit((1 << _LOCAL_ROW_BITS) - 1))
    )
    earlier = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        kept.groupBy("__part")  # one row per shuffle partition
        .agg(F.count(F.lit(1)).alias("n"))
        .select("__part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    )
    numbered = kept.join(F.broadcast(offsets), "__part")
    return numbered.select(*df.columns, (F.col("__before") + F.col("__row") + start).cast("long").alias(name))


def zip_join(frames: Sequence[DataFrame], orders: Sequence[Sequence[Column]], name: str = "rn") -> DataFrame:
    """Put the i-th rows of several frames side by side; the shortest frame sets the length."""
    indexed = [zip_with_index(df, order, name) for df, order in zip(frames, orders)]
    joined = indexed[0]
    for other in indexed[1:]:
        joined = joined.join(other, name)
    return joined


def bucket_assign(
    members: DataFrame, buckets: DataFrame, size: int, member_order: Sequence[Column], bucket_order: Sequence[Column]
) -> DataFrame:
    """Give each bucket the next ``size`` members in order; members past the last bucket drop out."""
    left = zip_with_index(members, member_order, "member_rn").withColumn(
        "bucket_rn", F.call_function("div", F.col("member_rn") - 1, F.lit(size).cast("long")) + 1
    )
    return left.join(zip_with_index(buckets, bucket_order, "bucket_rn"), "bucket_rn")
