"""Fixed-window rate limit: a key's first call opens a window, the first ``max_calls`` calls in it pass.

Windows of one key depend on each other, so a key's calls are decided in time order. Tasks stream over
sorted rows, decide a batch of them at once and keep one window and one counter, whatever the size of a key.
A hot key is cut into
chunks of about equally many calls in time order: each chunk first works out where any window reaching
into it would leave it, the chunks are linked by that, and all chunks are then walked at the same time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import epoch_micros
from .skew import SEGMENT_ROWS, HotGroup, hot_groups, only_hot, piece_count, range_pieces, without_hot

# task code travels with the task: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NO_WINDOW = -(2**62)  # ends earlier than any time
_HELPERS = ["__group", "__chunk", "__t", "__end", "__used"]
_DECIDED = ["allowed", "window_end", "calls"]
_BEFORE = -1  # number of the chunk that stands for earlier runs


def _openings(times: np.ndarray, is_call: np.ndarray, begins: np.ndarray, entered: np.ndarray, width: int) -> np.ndarray:
    """The row that opened the window of each row. Rows are sorted by group and time.

    Rows that are no calls stand for windows that are open when their group begins; ``entered`` is their end.
    The first call at or after a window's end is found for all rows at once. Following these jumps from the rows
    that begin a group marks all openings; jumps of doubled length take a logarithmic number of steps.
    """
    n = len(times)
    after_entry = np.append(False, ~is_call[:-1])
    follows = np.append(is_call[1:] & ~begins[1:], False)  # a call of the same group comes next
    lasting = np.where(~is_call & follows, np.maximum(0, entered - np.append(times[1:], 0)), 0)
    far = max(width, int(lasting.max()))
    # places on a line where longer gaps are cut to ``far``, which no window bridges, as is the gap between groups
    gaps = np.append(far, np.minimum(np.diff(times), far))
    place = np.cumsum(np.where(begins | ~is_call | after_entry, far, gaps))
    following = np.searchsorted(place, np.where(is_call, place + width, np.append(place[1:], place[-1] + far) + lasting))
    following = np.append(following, n)
    opens = np.append(begins, True)
    opens[0] = True
    jump = following
    while True:
        at = np.flatnonzero(opens)
        if opens[following[at]].all():
            break
        opens[jump[at]] = True
        jump = jump[jump]
    return np.maximum.accumulate(np.where(opens[:n], np.arange(n), 0))


def _decided(
    times: np.ndarray, is_call: np.ndarray, begins: np.ndarray, entered: np.ndarray, counted: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """End of each row's window, and its number in it."""
    at = _openings(times, is_call, begins, entered, width)
    own = is_call[at]
    ends = np.where(own, times[at] + width, entered[at])
    return ends, np.where(own, 1, counted[at]) + np.arange(len(times)) - at


def decide_times(times: np.ndarray, end: int, used: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Window ends and numbers of one key's sorted call times, after a window with that end and so many calls."""
    size = len(times) + 1
    is_call = np.arange(size) > 0
    at_entry = np.where(is_call, 0, [end] + [0] * (size - 1)), np.where(is_call, 0, [used] + [0] * (size - 1))
    ends, calls = _decided(np.append(NO_WINDOW, times), is_call, ~is_call, *at_entry, width)
    return ends[1:], calls[1:]


def _rows_at_once(width: int) -> int:
    return max(2, (1 << 61) // max(width, 1))  # places on the line stay within a long


def _walk(batches: Iterator[pa.RecordBatch], max_calls: int, width: int) -> Iterator[pa.RecordBatch]:
    """Decide each call. Rows come sorted by (group, chunk, time).

    A row whose ``__used`` is set is no call: it says in which state its chunk is entered, and being
    earlier than any call it comes first. Without such a row a chunk is entered with no open window.
    """
    last, end, used = None, NO_WINDOW, 0
    for whole in batches:
        step = min(max(1, whole.num_rows), _rows_at_once(width))
        for batch in (whole.slice(low, step) for low in range(0, whole.num_rows, step)):
            group = batch.column("__group").dictionary_encode()
            names, code = group.dictionary, group.indices.to_numpy()
            chunk, times = (batch.column(c).to_numpy() for c in ("__chunk", "__t"))
            entered, counted = (pc.fill_null(batch.column(c), 0).to_numpy() for c in ("__end", "__used"))
            is_call = batch.column("__used").is_null().to_numpy(zero_copy_only=False)
            begins = np.append(True, (np.diff(code) != 0) | (np.diff(chunk) != 0))
            # the window left open by the rows before stands in front, whether it is still the same group or not
            begins[0] = (names[code[0]].as_py(), chunk[0]) != last
            front = (np.append(x, y) for x, y in ((NO_WINDOW, times), (False, is_call), (True, begins), (end, entered), (used, counted)))
            ends, calls = (x[1:] for x in _decided(*front, width))
            last, end, used = (names[code[-1]].as_py(), chunk[-1]), ends[-1], calls[-1]
            columns = [name for name in batch.schema.names if name not in _HELPERS]
            numbers = pa.array(calls, pa.int64())
            decided = [pc.less_equal(numbers, max_calls), pa.array(ends, pa.int64()), numbers]
            rows = [*[batch.column(name) for name in columns], *decided]
            yield pa.RecordBatch.from_arrays(rows, names=[*columns, *_DECIDED]).filter(pa.array(is_call))


def _chunk_exits(width: int):
    """Per chunk: where windows that reach into it leave it, by the end of the entering window.

    A window that ended by ``upto`` leads to a last window ending at ``exit`` with ``n`` calls so far.
    ``exit`` is missing where all calls of the chunk still belong to the entering window.
    """

    def exits(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__t")
        times = pdf["__t"].to_numpy()
        calls = np.concatenate([[0], np.cumsum(pdf["n"].to_numpy())])
        following = np.searchsorted(times, times + width)
        size = len(times)
        last = np.where(following < size, following, np.arange(size))
        while not np.array_equal(last, further := last[last]):  # jumps of doubled length
            last = further
        first_open = np.searchsorted(times, times[0] + width)  # later calls start no first window here
        keep = np.arange(min(first_open + 1, size))
        merged = np.append(last[keep][1:] != last[keep][:-1], True)
        keep = keep[merged]
        rows = pd.DataFrame(
            {"__upto": times[keep], "__exit": (times + width)[last[keep]], "n": calls[size] - calls[last[keep]]}
        )
        if first_open >= size:
            rows.loc[len(rows)] = [2**62, NO_WINDOW, calls[size]]
        rows.insert(0, "__chunk", key[1])
        rows.insert(0, "__group", key[0])
        return rows

    return exits


def _link(pieces: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Walk the exits of each group chunk by chunk; give the state in which each chunk is entered."""
    group, chunk, end, used, done = None, None, NO_WINDOW, 0, False
    for pdf in pieces:
        out = []
        groups, chunks, uptos = (pdf[c].to_numpy() for c in ("__group", "__chunk", "__upto"))
        cuts = np.flatnonzero((groups[1:] != groups[:-1]) | (chunks[1:] != chunks[:-1])) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(pdf)]):
            if low == high:
                continue
            if groups[low] != group:
                group, chunk, end, used = groups[low], None, NO_WINDOW, 0
            if chunks[low] != chunk:
                chunk, done = chunks[low], False
                if chunk != _BEFORE:
                    out.append((group, chunk, end, used))
            at = low + np.searchsorted(uptos[low:high], end)
            if not done and at < high:
                done, leaves, n = True, int(pdf["__exit"].iat[at]), int(pdf["n"].iat[at])
                end, used = (end, used + n) if leaves == NO_WINDOW else (leaves, n)
        yield pd.DataFrame(out, columns=["__group", "__chunk", "__end", "__used"])


def rate_limit(
    events: DataFrame,
    key: str,
    ts: str,
    order: str,
    max_calls: int = 100,
    seconds: int = 60,
    hot: Sequence[HotGroup] | None = None,
    rows_per_chunk: int = SEGMENT_ROWS,
    open_windows: DataFrame | None = None,
) -> DataFrame:
    """All events with ``allowed``, the end of the window they fell in (epoch microseconds) and their
    number in it. Calls of one key at the same time are taken by ``order``.

    ``open_windows`` (key, window_end, calls) carries on from earlier events.
    """
    width = seconds * 1_000_000
    hot = hot_groups(events, [key]) if hot is None else hot
    group = F.coalesce(F.col(key).cast("string"), F.lit("\0")).alias("__group")
    time = epoch_micros(events, ts).alias("__t")
    rows = events.select("*", group, time)
    no_state = {"__end": F.lit(None).cast("long"), "__used": F.lit(None).cast("long")}
    ordinary = without_hot(rows, [key], hot)
    calls = ordinary.withColumn("__chunk", F.lit(0).cast("long")).withColumns(no_state)
    entries = None
    if open_windows is not None:
        cold = without_hot(open_windows, [key], hot)
        entries = cold.select(
            group,
            F.lit(0).cast("long").alias("__chunk"),
            F.col("window_end").alias("__end"),
            F.col("calls").alias("__used"),
        )
    if hot:
        sorting = [F.asc("__group"), F.asc("__t"), F.asc(order)]
        chunked = range_pieces(only_hot(rows, [key], hot), sorting, piece_count(hot, rows_per_chunk), "__chunk")
        chunked = chunked.withColumn("__chunk", F.col("__chunk").cast("long"))
        distinct = chunked.groupBy("__group", "__chunk", "__t").agg(F.count(F.lit(1)).alias("n"))
        exits = distinct.groupBy("__group", "__chunk").applyInPandas(
            _chunk_exits(width), "__group string, __chunk long, __upto long, __exit long, n long"
        )
        if open_windows is not None:
            before = only_hot(open_windows, [key], hot).select(
                group,
                F.lit(_BEFORE).cast("long").alias("__chunk"),
                F.lit(-NO_WINDOW).cast("long").alias("__upto"),
                F.col("window_end").alias("__exit"),
                F.col("calls").alias("n"),
            )
            exits = exits.unionByName(before)
        linked = (
            exits.repartition("__group")
            .sortWithinPartitions("__group", "__chunk", "__upto")
            .mapInPandas(_link, "__group string, __chunk long, __end long, __used long")
        )
        entries = linked if entries is None else entries.unionByName(linked)
        calls = calls.unionByName(chunked.withColumns(no_state))
    if entries is not None:
        calls = calls.unionByName(entries.withColumn("__t", F.lit(NO_WINDOW).cast("long")), allowMissingColumns=True)
    # entry states travel as rows, not through a join: the shuffle below must be the last thing before
    # the walk, as a join next to it could be planned in its place and spread a chunk over tasks
    schema = events.schema.simpleString()[len("struct<") : -1]
    return (
        calls.select(*events.columns, *_HELPERS)
        .repartition("__group", "__chunk")
        .sortWithinPartitions("__group", "__chunk", "__t", order)
        .mapInArrow(
            lambda batches: _walk(batches, max_calls, width),
            f"{schema}, allowed boolean, window_end long, calls long",
        )
    )
