"""Nearest neighbours by a block matrix join.

Queries and candidates are dealt into tiles of bounded size; every query block meets every candidate block in
a task of its own. A tile multiplies int8 codes, which gives each cosine with an error bound. Pairs that can
still be among the nearest are computed again from the original vectors in double precision, kept in one heap
per query, and the heaps of all tiles are merged. The result is exact.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows without
an id. Vectors of different length are never compared. An id that is repeated counts once, by the nearest of its
vectors. Ties go to the smaller id. Empty tables give an empty result; further columns are never read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

TILE_ROWS = 2048
PAIRS_AT_ONCE = 1 << 16  # pairs computed again at a time
EXACT_COLUMNS = 1024  # so many products of int8 codes add up exactly in float32
SLACK = 1e-9  # rounding of the bounds themselves


def usable(vector: Column) -> Column:
    value = vector.cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))


def _matrix(batch: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = batch.column("id").combine_chunks().to_numpy(zero_copy_only=False)
    column = batch.column("vector").combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return ids, flat.reshape(len(ids), -1)


def _codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of the unit vectors, their scale, the length of the coded vector and of its error."""
    peak = np.abs(vectors).max(axis=1, keepdims=True)
    unit = vectors / peak  # keeps very large and very small vectors in range
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1, keepdims=True) / 127
    codes = np.rint(unit / scale)
    coded = codes * scale
    length, error = np.sqrt((coded * coded).sum(axis=1)), np.sqrt(((unit - coded) ** 2).sum(axis=1))
    return codes.astype(np.int8), scale[:, 0], length, error


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in an order of additions that depends on the row alone, so equal vectors tie exactly."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors whose squares would leave the range of doubles are scaled by a power of two, which is exact."""
    peak = np.abs(vectors).max(axis=1, keepdims=True)
    odd = (peak > 1e100) | (peak < 1e-100)
    return np.where(odd, np.ldexp(vectors, -np.frexp(peak)[1]), vectors)


class Heap:
    """The k best scores of different ids; of equal scores the smaller ids."""

    def __init__(self, k: int):
        self.k, self.entries, self.held = k, [], {}

    def offer(self, score: float, other: int) -> None:
        entry, known = (score, -other), self.held.get(other)
        if known is not None:  # the id was here with another vector
            if score > known:
                self.entries[self.entries.index((known, -other))] = entry
                heapq.heapify(self.entries)
                self.held[other] = score
        elif len(self.entries) < self.k:
            heapq.heappush(self.entries, entry)
            self.held[other] = score
        elif entry > self.entries[0]:
            del self.held[-heapq.heapreplace(self.entries, entry)[1]]
            self.held[other] = score


def tile_nearest(query_ids, queries, ids, vectors, k: int) -> list[tuple[int, float, int]]:
    """The k nearest candidates of this tile for each query: (query id, score, id)."""
    distinct, place = np.unique(vectors, axis=0, return_inverse=True)
    place = place.reshape(-1)
    order = np.lexsort((ids, place))
    ids_at, place_at = ids[order], place[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (ids_at[1:] != ids_at[:-1]) | (place_at[1:] != place_at[:-1])
    ids_at, place_at = ids_at[fresh], place_at[fresh]
    first = np.searchsorted(place_at, np.arange(len(distinct) + 1))
    exact_q, exact_c = _scaled(queries), _scaled(distinct)
    q_code, q_scale, q_len, q_err = _codes(queries)
    c_code, c_scale, c_len, c_err = _codes(distinct)
    product = np.zeros((len(queries), len(distinct)))
    for low in range(0, queries.shape[1], EXACT_COLUMNS):
        part = slice(low, low + EXACT_COLUMNS)
        product += q_code[:, part].astype(np.float32) @ c_code[:, part].astype(np.float32).T
    product *= q_scale[:, None] * c_scale[None, :]
    bound = q_err[:, None] + q_len[:, None] * c_err[None, :] + SLACK
    # each distinct vector stands for its smallest id, and may share it with others; one may be the query's own
    owner = ids_at[first[:-1]]
    owners, begins = np.unique(np.sort(owner), return_index=True)
    least = product - bound
    if len(owners) < len(owner):
        least = np.maximum.reduceat(least[:, np.argsort(owner, kind="stable")], begins, axis=1)
    floor = np.partition(least, len(owners) - k - 1, axis=1)[:, len(owners) - k - 1] if len(owners) > k else None
    alive = np.ones(product.shape, dtype=bool) if floor is None else product + bound >= floor[:, None]
    rows, columns = np.nonzero(alive)
    heaps: dict[int, Heap] = {}
    for low in range(0, len(rows), PAIRS_AT_ONCE):
        r, c = rows[low : low + PAIRS_AT_ONCE], columns[low : low + PAIRS_AT_ONCE]
        for i, j, score in zip(r.tolist(), c.tolist(), _cosines(exact_q[r], exact_c[c]).tolist()):
            if i not in heaps:
                heaps[i] = Heap(k)
            own = query_ids[i]
            same = ids_at[first[j] : min(first[j + 1], first[j] + k + 1)]  # the smallest ids of this vector
            for other in same[same != own][:k].tolist():
                heaps[i].offer(score, other)
    return [(int(query_ids[i]), score, -other) for i, heap in heaps.items() for score, other in heap.entries]


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", tile_rows: int = TILE_ROWS
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k nearest other ids of every query row by cosine."""
    rows = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        is_query.alias("asks"),
        F.size(vector_col).alias("dim"),
    )
    n, n_asked = rows.agg(F.count(F.lit(1)), F.count_if("asks")).head()
    n_blocks, q_blocks = max(1, math.ceil(n / tile_rows)), max(1, math.ceil(n_asked / tile_rows))
    spread = F.xxhash64("id")
    tile = ["dim", "n_block", "q_block"]
    held = rows.select(
        "id", "vector", "dim", F.pmod(spread, F.lit(n_blocks)).alias("n_block"), F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)).cast("array<long>")).alias("q_block")
    )
    asked = rows.where("asks").select(
        "id", "vector", "dim", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<long>")).alias("n_block"), F.pmod(spread, F.lit(q_blocks)).alias("q_block")
    )
    schema = "query_id long, score double, vec_id long"

    def join_tile(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            query_ids, queries = _matrix(left)
            once = list({(i, v.tobytes()): at for at, (i, v) in enumerate(zip(query_ids.tolist(), queries))}.values())
            found = tile_nearest(query_ids[once], queries[once], *_matrix(right), k)
        names = ["query_id", "score", "vec_id"]
        kinds = [pa.int64(), pa.float64(), pa.int64()]
        return pa.table([pa.array([x[i] for x in found], kind) for i, kind in enumerate(kinds)], names)

    near = asked.groupBy(*tile).cogroup(held.groupBy(*tile)).applyInArrow(join_tile, schema)
    best = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
