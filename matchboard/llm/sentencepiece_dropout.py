"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

Merges are taken from an agenda in the order of the model's scores. With dropout p, each merge that comes up
is skipped with probability p, drawn anew for every occurrence of a run: a hash of the seed, the document's id
and text, and the run's place in the text tells how many merges come up until the next one is skipped. So the
same seed always gives the same segmentation of a document, and equal runs are cut in as many ways as chance
gives them. A task remembers the ids of a run for the skips that led to them, not the draws.

Spaces are part of the pieces, a space is put before the text, and letters without a piece fall back to their
UTF-8 bytes, so decoding gives back every text exactly, also texts that hold the model's own space mark.

Null texts count as empty; empty texts have no tokens. Null ids and repeated rows are encoded like any other;
an empty table gives an empty result. ``encoded`` keeps all columns and replaces one of the new name.
The model file is a parameter and is read on the executors where it is used.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import repeat

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

MODEL = "piece_bpe_32k.model"
SPACE_MARK = "▁"
# No piece reaches over the end of a run. Most models have no piece that joins a letter and a following mark or
# digit either; their runs end there too.
RUN = re.compile(r"\n| *[^ \n]+| +")
FINE_RUN = re.compile(r"\n| *[^\W\d_¹²³]+| *(?:[^\w \n]|[\d_¹²³])+| +")
LETTER = re.compile(r"[^\W\d_¹²³]")
KEEP_RUNS = 800_000  # runs that a task remembers, each with its skips; some 200 bytes each
DOCS_AT_ONCE = 256
LONG_RUN = 64  # longer ones are not remembered; fewer than 3 * LONG_RUN merges come up in one
MOST_AT_ONCE = 255  # merges that one draw goes over without a skip; the next draw goes on from there
MASK = (1 << 64) - 1
NEVER = (1 << 31) - 1
UNKNOWN = (1 << 31) - 1
RUNS_AT_ONCE = 4096  # bounds the memory for runs that are cut together
LANE, GOLDEN, MIX_1, MIX_2 = 0xC2B2AE3D27D4EB4F, 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def _mixed(z):
    """The last step of splitmix64, on a whole number or an array of them."""
    if isinstance(z, np.ndarray):
        z = (z ^ z >> np.uint64(30)) * np.uint64(MIX_1)
        z = (z ^ z >> np.uint64(27)) * np.uint64(MIX_2)
        return z ^ z >> np.uint64(31)
    z = (z ^ z >> 30) * MIX_1 & MASK
    z = (z ^ z >> 27) * MIX_2 & MASK
    return z ^ z >> 31


class _Table:
    """Pairs of symbols, and the merge and its order that each pair gives; looked up by the array."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        self.shift = 64 - max(4, (4 * len(pairs)).bit_length())
        keys = [a << 32 | b for a, b in pairs]
        size = 1 << 64 - self.shift
        self.keys, self.place = np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.int32)
        self.most = 1  # places to look at
        for at, key in enumerate(keys):
            slot = (key * GOLDEN & MASK) >> self.shift
            tries = 1
            while self.keys[slot] >= 0:
                slot, tries = (slot + 1) % size, tries + 1
            self.keys[slot], self.place[slot], self.most = key, at, max(self.most, tries)
        self.piece = np.array([p for p, _ in pairs.values()] + [-1], dtype=np.int32)
        self.rank = np.array([r for _, r in pairs.values()] + [NEVER], dtype=np.int32)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The number of each pair, or the last number for pairs that do not merge."""
        key = left.astype(np.int64) << 32 | right
        slot = (key.astype(np.uint64) * np.uint64(GOLDEN) >> np.uint64(self.shift)).astype(np.int64)
        found = np.full(len(key), len(self.rank) - 1, dtype=np.int32)
        open_ = np.arange(len(key))
        for _ in range(self.most):
            held = self.keys[slot]
            hit = held == key
            found[open_[hit]] = self.place[slot[hit]]
            go = ~hit & (held >= 0)
            if not go.any():
                break
            open_, key, slot = open_[go], key[go], (slot[go] + 1) % len(self.keys)
        return found


class Codec:
    def __init__(self, model_file: str, dropout: float = 0.0, seed: int = 0, keep_runs: int = KEEP_RUNS):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        plain = [i for i in range(len(pieces)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.ids = {pieces[i].replace(SPACE_MARK, " "): i for i in plain}
        score = {p: -model.get_score(i) for p, i in self.ids.items() if len(p) > 1}
        order = {v: rank for rank, v in enumerate(sorted(set(score.values())))}
        self.merges = {p: order[v] for p, v in score.items()}  # their order in the agenda
        kinds = [[bool(LETTER.match(c)) for c in p.lstrip(" ")] for p in self.ids]
        self.run = RUN if any(a != b for k in kinds for a, b in zip(k, k[1:])) or any("\n" in p for p in self.ids) else FINE_RUN
        self.byte_ids = {int(pieces[i][1:-1], 16): i for i in range(len(pieces)) if model.is_byte(i)}
        self.bytes_of = [b""] * len(pieces)
        for piece, i in self.ids.items():
            self.bytes_of[i] = piece.encode()
        for byte, i in self.byte_ids.items():
            self.bytes_of[i] = bytes([byte])
        self.code = "H" if len(pieces) <= 1 << 16 else "I"
        self.kind = np.dtype(self.code)
        self.n_pieces = len(pieces)
        pairs = {}
        for piece, rank in self.merges.items():
            for cut in range(1, len(piece)):
                a, b = self._symbol(piece[:cut]), self._symbol(piece[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = (self.ids[piece], rank)
        self.table = _Table(pairs)
        self.dropout = dropout
        self.seed, self.keep_runs = seed, keep_runs
        # draws below the n-th bound go over fewer than n merges before the one that is skipped
        bounds = [min(MASK, int((1 - (1 - dropout) ** (n + 1)) * (1 << 64))) for n in range(MOST_AT_ONCE)]
        self.bounds, self.bounds_of = np.array(bounds, dtype=np.uint64), bounds
        self._forget()

    def _symbol(self, part: str) -> int | None:
        """A piece's id; a letter that is no piece has a number above all ids; anything else never occurs."""
        found = self.ids.get(part)
        return found if found is not None else self.n_pieces + ord(part) if len(part) == 1 else None

    def _skips(self, draw: int) -> Iterator[int]:
        """The merges that are skipped, by their number in the order they come up, for one occurrence of a run."""
        at = -1
        while self.bounds_of[-1]:  # without dropout there are none
            gap = bisect_right(self.bounds_of, _mixed(draw))
            draw = draw + GOLDEN & MASK
            at += gap
            if gap < MOST_AT_ONCE:
                at += 1
                yield at

    def _gaps(self, draws: np.ndarray) -> np.ndarray:
        """How many merges come up before the next one that is skipped; more than any short run has, if none is."""
        return np.searchsorted(self.bounds, _mixed(draws), side="right")

    def cut(self, run: str, skips: Iterator[int] = iter(())) -> tuple[list[str], int]:
        """The pieces of a run, and how many merges came up; ``skips`` ascend."""
        if len(run) > LONG_RUN:
            return self._cut_long(run, skips)
        rank, skip, came = self.merges.get, next(skips, -1), 0
        parts = list(run)
        agenda = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]  # of a short run, the merge of each neighbour
        while agenda:
            first = min(agenda)
            if first == NEVER:
                break
            i = agenda.index(first)
            came += 1
            if came - 1 == skip:
                skip = next(skips, -1)
                agenda[i] = NEVER
                continue
            piece = parts[i] = parts[i] + parts.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = rank(parts[i - 1] + piece, NEVER)
            if i < len(agenda):
                agenda[i] = rank(piece + parts[i + 1], NEVER)
        return parts, came

    def _cut_long(self, run: str, skips: Iterator[int]) -> tuple[list[str], int]:
        n = len(run)
        merges, skip, came = self.merges, next(skips, -1), 0
        parts: list[str | None] = list(run)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        agenda = [(m, i, p) for i in range(n - 1) if (m := merges.get(p := run[i : i + 2])) is not None]
        heapify(agenda)
        while agenda:
            _, i, piece = heappop(agenda)
            j = after[i]
            if j < 0 or parts[i] is None or parts[i] + parts[j] != piece:
                continue  # one of the two has been merged otherwise
            came += 1
            if came - 1 == skip:
                skip = next(skips, -1)
                continue
            parts[i], parts[j] = piece, None
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (m := merges.get(p := piece + parts[k])) is not None:
                    heappush(agenda, (m, i, p))
            k = before[i]
            if k >= 0 and (m := merges.get(p := parts[k] + piece)) is not None:
                heappush(agenda, (m, k, p))
        return [p for p in parts if p is not None], came

    def _ids_of(self, pieces: list[str]) -> bytes:
        ids = list(map(self.ids.get, pieces))
        if None in ids:
            ids = [n for i, p in zip(ids, pieces) for n in ([i] if i is not None else [self.byte_ids[b] for b in p.encode()])]
        return array(self.code, ids).tobytes()

    # What is remembered of short runs: states, which are a run and the merges skipped so far. A state knows how many
    # merges come up if no further one is skipped, and the ids; or, as long as it was only passed through, nothing.

    def _forget(self) -> None:
        self.root: dict[str, int] = {}  # the state of a run without skips
        self.onward: dict[int, int] = {}  # a state and the next skip: the state after it
        self.came = np.full(1 << 12, UNKNOWN, dtype=np.int32)
        self.found: list[bytes] = []

    def _remember(self, runs: list[str], ids: list[bytes], came: np.ndarray, skipped: list[list[int]]) -> None:
        """Keep what was found for runs; states that are only passed through on the way know nothing yet."""
        root, onward, found = self.root, self.onward, self.found
        room = len(found) + len(runs) + sum(map(len, skipped)) + 1
        if room > len(self.came):
            self.came = np.append(self.came, np.full(max(room, len(self.came)), UNKNOWN, dtype=np.int32))
        for run, data, steps, skips in zip(runs, ids, came.tolist(), skipped):
            n = root.get(run)
            if n is None:
                n = root[run] = len(found)
                found.append(b"")
            for one in skips:
                key = n << 9 | one
                n = onward.get(key)
                if n is None:
                    n = onward[key] = len(found)
                    found.append(b"")
            found[n], self.came[n] = data, steps

    def _cut_many(self, runs: list[str], draws: np.ndarray) -> tuple[list[bytes], np.ndarray, list[list[int]]]:
        """For short runs: the ids, how many merges came up and the skips among them. All take a step at a time."""
        out, came, skipped = [b""] * len(runs), np.zeros(len(runs), dtype=np.int32), [[] for _ in runs]
        letters, number = np.unique(np.frombuffer("".join(runs).encode("utf-32-le"), dtype="<u4"), return_inverse=True)
        symbols = np.array([self._symbol(chr(c)) for c in letters.tolist()], dtype=np.int32)[number]
        size = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs))
        starts = np.cumsum(size) - size
        order = np.argsort(size, kind="stable")  # runs of about one length together
        for low in range(0, len(runs), RUNS_AT_ONCE):
            who = order[low : low + RUNS_AT_ONCE]
            n, width = size[who], int(size[who].max())
            column = np.arange(width)
            parts = np.where(column < n[:, None], symbols[np.minimum(starts[who][:, None] + column, len(symbols) - 1)], -1)
            ranks = np.full((len(who), width), NEVER, dtype=np.int32)  # of the merge of each part with the next
            row, i = np.nonzero(column[1:] < n[:, None])
            ranks[row, i] = self.table.rank[self.table.find(parts[row, i], parts[row, i + 1])]
            draw, steps = draws[who], np.zeros(len(who), dtype=np.int64)
            skip = self._gaps(draw)
            while len(who):
                i = ranks.argmin(axis=1)
                row = np.arange(len(who))
                ended = ranks[row, i] == NEVER
                if ended.any():
                    done = parts[ended]
                    data, wide = done.astype(self.kind).tobytes(), done.shape[1] * self.kind.itemsize
                    plain = (done < self.n_pieces).all(axis=1)
                    for r, (at, size_, own) in enumerate(zip(who[ended].tolist(), n[ended].tolist(), plain.tolist())):
                        out[at] = data[r * wide : r * wide + size_ * self.kind.itemsize] if own else self._ids_of_symbols(done[r, :size_])
                    came[who[ended]] = steps[ended]
                    go = ~ended
                    who, n, parts, ranks, draw, steps, skip, i = who[go], n[go], parts[go], ranks[go], draw[go], steps[go], skip[go], i[go]
                    if not len(who):
                        break
                    row = np.arange(len(who))
                skips = steps == skip
                steps = steps + 1
                if skips.any():
                    s = np.flatnonzero(skips)
                    for r, at in zip(who[s].tolist(), skip[s].tolist()):
                        skipped[r].append(at)
                    ranks[s, i[s]] = NEVER
                    draw[s] += np.uint64(GOLDEN)
                    skip[s] += 1 + self._gaps(draw[s])
                m = np.flatnonzero(~skips)
                if len(m):
                    at = i[m]
                    joined = self.table.piece[self.table.find(parts[m, at], parts[m, at + 1])]
                    beyond = column[: parts.shape[1] - 1] > np.where(skips, parts.shape[1], i)[:, None]
                    for held in (parts, ranks):  # close the gaps
                        np.copyto(held[:, :-1], held[:, 1:].copy(), where=beyond)
                    parts[m, at] = joined
                    n[m] -= 1
                    ranks[m, at] = NEVER
                    q = np.flatnonzero(at > 0)
                    ranks[m[q], at[q] - 1] = self.table.rank[self.table.find(parts[m[q], at[q] - 1], joined[q])]
                    q = np.flatnonzero(at < n[m] - 1)
                    ranks[m[q], at[q]] = self.table.rank[self.table.find(joined[q], parts[m[q], at[q] + 1])]
        return out, came, skipped

    def _ids_of_symbols(self, symbols: np.ndarray) -> bytes:
        """The ids of pieces, and of the bytes of letters that are none."""
        parts = [[i] if i < self.n_pieces else [self.byte_ids[b] for b in chr(i - self.n_pieces).encode()] for i in symbols.tolist()]
        return array(self.code, [i for part in parts for i in part]).tobytes()

    def encode_many(self, texts: list[str | None], names: list) -> list[np.ndarray]:
        """Token ids of each text; a name says which document it is, as far as the draws go."""
        if len(self.found) > self.keep_runs:
            self._forget()
        runs, keys, ends = [], [], [0]
        for text, name in zip(texts, names):
            cut = self.run.findall(" " + text) if text else []
            runs += cut
            key = xxhash.xxh64_intdigest(text or "", xxhash.xxh64_intdigest(str(name), self.seed & MASK))
            keys.append(np.arange(1, len(cut) + 1, dtype=np.uint64) * np.uint64(LANE) + np.uint64(key))
            ends.append(len(runs))
        draws = np.concatenate(keys) if keys else np.empty(0, dtype=np.uint64)
        state = np.fromiter(map(self.root.get, runs, repeat(-1)), dtype=np.int64, count=len(runs))
        skip, draw = self._gaps(draws), draws.copy()
        missing, walking = [np.flatnonzero(state < 0)], np.flatnonzero(state >= 0)
        while len(walking):
            walking = walking[skip[walking] < self.came[state[walking]]]
            after = state[walking] << 9 | skip[walking]
            onward = np.fromiter(map(self.onward.get, after.tolist(), repeat(-1)), dtype=np.int64, count=len(after))
            missing.append(walking[onward < 0])
            walking = walking[onward >= 0]
            state[walking] = onward[onward >= 0]
            draw[walking] += np.uint64(GOLDEN)
            skip[walking] += 1 + self._gaps(draw[walking])
        missing = np.concatenate(missing)
        out = list(map(self.found.__getitem__, np.maximum(state, 0).tolist())) if self.found else [b""] * len(runs)
        short = [at for at in missing.tolist() if len(runs[at]) <= LONG_RUN]
        for at in missing.tolist():
            if len(runs[at]) > LONG_RUN:
                out[at] = self._ids_of(self.cut(runs[at], self._skips(int(draws[at])))[0])
        if short:
            cut = [runs[at] for at in short]
            ids, came, skipped = self._cut_many(cut, draws[short])
            self._remember(cut, ids, came, skipped)
            for at, data in zip(short, ids):
                out[at] = data
        return [np.frombuffer(b"".join(out[low:high]), dtype=self.kind) for low, high in zip(ends, ends[1:])]

    def encode(self, text: str | None, name: object = None) -> np.ndarray:
        return self.encode_many([text], [name])[0]

    def decode(self, ids) -> str:
        """The text that was encoded."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids)).decode()[1:]


@lru_cache(maxsize=4)
def codec(model_file: str, dropout: float, seed: int, keep_runs: int = KEEP_RUNS) -> Codec:
    return Codec(model_file, dropout, seed, keep_runs)


def encoded(
    docs: DataFrame, dropout: float = 0.1, seed: int = 0, name: str = "token_ids", model_file: str | None = None,
    id_col: str = "doc_id", text_col: str = "text", keep_runs: int = KEEP_RUNS,
) -> DataFrame:
    """All rows and columns, and the token ids of the text.

    Ids leave a task some hundred documents at a time, so that they never fill its memory.
    """
    file = model_file or public_tokenizers.path(MODEL)
    rows = docs.drop(name)
    id_at, text_at = rows.columns.index(id_col), rows.columns.index(text_col)
    schema = StructType([*rows.schema.fields, StructField(name, ArrayType(IntegerType()))])

    def encode(batches):
        c = codec(file, dropout, seed, keep_runs)
        for batch in batches:
            for start in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(start, DOCS_AT_ONCE)
                names, texts = part.column(id_at).to_pylist(), part.column(text_at).to_pylist()
                ids = c.encode_many(texts, names)
                offsets = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.record_batch([*part.columns, lists], numbered.names)

    # numbered names on the way, as any name may occur among the columns
    numbered = StructType([StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(schema)])
    return rows.toDF(*numbered.names[:-1]).mapInArrow(encode, numbered).toDF(*schema.names)


def decoded(rows: DataFrame, ids_col: str = "token_ids", name: str = "text", model_file: str | None = None) -> DataFrame:
    """All rows and columns, and the text that the token ids stand for."""
    file = model_file or public_tokenizers.path(MODEL)

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        c = codec(file, 0.0, 0)
        return pd.Series([c.decode(i) if i is not None else None for i in ids], dtype=object)

    return rows.withColumn(name, text(F.col(f"`{ids_col}`")))


def round_trips(
    docs: DataFrame, dropout: float = 0.1, seed: int = 0, model_file: str | None = None, id_col: str = "doc_id",
    text_col: str = "text", keep_runs: int = 2 * KEEP_RUNS,
) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_crc32, lossless): each text encoded and decoded again."""
    file = model_file or public_tokenizers.path(MODEL)

    @F.pandas_udf("struct<n_tokens long, ids_crc32 long, lossless boolean>")
    def both(names: pd.Series, texts: pd.Series) -> pd.DataFrame:
        c = codec(file, dropout, seed, keep_runs)
        out, names, texts = [], names.tolist(), texts.tolist()
        for start in range(0, len(texts), DOCS_AT_ONCE):
            part = texts[start : start + DOCS_AT_ONCE]
            for t, ids in zip(part, c.encode_many(part, names[start : start + DOCS_AT_ONCE])):
                out.append((len(ids), zlib.crc32(ids.astype("<u4").tobytes()), c.decode(ids) == (t or "")))
        return pd.DataFrame(out, columns=["n_tokens", "ids_crc32", "lossless"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.select("doc_id", both(F.col("doc_id").cast("string"), "text").alias("r")).select("doc_id", "r.*")
