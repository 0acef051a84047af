"""Benchmark items in documents, by pigeonhole edit matching on words.

An item of m words may differ in k = floor(max_error * m) words. It is split into k + 1 pieces of nearly equal
length; whatever k words were changed, left out or added, one piece stands in the document unchanged. Exact
piece hits are found by rolling hashes of word numbers, and every hit's surroundings are verified by Myers'
bit-parallel edit distance between the whole item and any run of the document's words.

Texts are compared as lower-case runs of letters, digits and underscores. Null and empty texts match nothing;
items without a word are left out; equal items are reported under each of their ids. Repeated rows are
reported as often as given, null ids too. Columns other than id and text are never read.

The items are a stated query set: they are collected in blocks of bounded size, and each block is matched with
all documents.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchboard.llm.common import text_of

WORD = re.compile(r"\w+")
MAX_ERROR = 0.2
BLOCK_BYTES = 4 << 20  # text of the items matched at a time
BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def pieces(n_words: int, max_error: float) -> list[tuple[int, int]]:
    """(start, end) of the error budget plus one pieces."""
    n = math.floor(max_error * n_words + 1e-9) + 1
    return [(n_words * i // n, n_words * (i + 1) // n) for i in range(n)]


def myers(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """The least edit distance between ``pattern`` and any run of ``text``, and where that run first ends."""
    masks: dict[int, int] = {}
    for i, word in enumerate(pattern):
        masks[word] = masks.get(word, 0) | 1 << i
    full, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    plus, minus, score = full, 0, len(pattern)
    best, end = score, 0
    for at, word in enumerate(text):
        equal = masks.get(word, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(horizontal | plus) & full
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus = down | ~(vertical | up) & full
        minus = up & vertical
        if score < best:
            best, end = score, at + 1
    return best, end


@dataclass
class Block:
    """Items of one block with the hashes of their pieces."""

    items: list[tuple[int | None, list[int], int]]  # id, numbered words, budget
    numbers: dict[str, int]
    lengths: dict[int, tuple[np.ndarray, list[list[tuple[int, int]]]]]  # by piece length: sorted hashes, (item, offset)


def _hashes(numbers: np.ndarray, length: int) -> np.ndarray:
    n = max(0, len(numbers) - length + 1)
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(length):
            out = out * BASE + numbers[i : i + n]
            out ^= out >> np.uint64(29)
    return out


def index_items(rows, max_error: float = MAX_ERROR) -> Block:
    numbers: dict[str, int] = {}
    items, by_length = [], {}
    for item_id, text in rows:
        words = [numbers.setdefault(w, len(numbers) + 1) for w in words_of(text)]
        if not words:
            continue
        cut = pieces(len(words), max_error)
        for start, end in cut:
            key = int(_hashes(np.array(words[start:end], dtype=np.uint64), end - start)[0])
            by_length.setdefault(end - start, {}).setdefault(key, []).append((len(items), start))
        items.append((item_id, words, len(cut) - 1))
    lengths = {n: (np.array(sorted(keys), dtype=np.uint64), [keys[k] for k in sorted(keys)]) for n, keys in by_length.items()}
    return Block(items, numbers, lengths)


def matches(block: Block, text: str | None) -> list[tuple[int | None, int, int, int]]:
    """(item id, distance, budget, word where the run ends) of each item found; the best run of each."""
    get = block.numbers.get
    numbers = np.array([get(w, 0) for w in words_of(text)], dtype=np.uint64)
    best: dict[int, tuple[int, int]] = {}
    asked: set[tuple[int, int]] = set()
    for length, (keys, places) in block.lengths.items():
        hashes = _hashes(numbers, length)
        if not len(hashes):
            continue
        at = np.searchsorted(keys, hashes)
        at[at == len(keys)] = 0
        for i in np.nonzero(keys[at] == hashes)[0].tolist():
            for item, offset in places[at[i]]:
                if (item, i - offset) in asked:
                    continue
                asked.add((item, i - offset))
                _, words, budget = block.items[item]
                low = max(0, i - offset - budget)
                around = numbers[low : i - offset + len(words) + budget].tolist()
                distance, end = myers(words, around)
                if distance <= budget and (item not in best or (distance, low + end) < best[item]):
                    best[item] = (distance, low + end)
    return [(block.items[i][0], d, block.items[i][2], end) for i, (d, end) in sorted(best.items())]


def _blocks(benchmark: DataFrame, max_error: float, id_col: str, text_col: str):
    """The indexed items, block by block."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), text_of(text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    for b in range(blocks):
        of_block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield benchmark.sparkSession.sparkContext.broadcast(index_items([(r.item_id, r.text) for r in of_block.collect()], max_error))


def find_items(
    docs: DataFrame, benchmark: DataFrame, max_error: float = MAX_ERROR, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Rows (doc_id, item_id, distance, allowed, end_word): every benchmark item in every document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kinds = [("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("allowed", pa.int32()), ("end_word", pa.int32())]
    found = []
    for block in _blocks(benchmark, max_error, item_id_col, item_text_col):

        def search(batches, block=block):
            for batch in batches:
                hits = [(i, *m) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for m in matches(block.value, t)]
                yield pa.record_batch([pa.array([h[c] for h in hits], kind) for c, (_, kind) in enumerate(kinds)], [n for n, _ in kinds])

        found.append(rows.mapInArrow(search, "doc_id long, item_id long, distance int, allowed int, end_word int"))
    result = found[0]
    for more in found[1:]:
        result = result.union(more)
    return result


def without_items(
    docs: DataFrame, benchmark: DataFrame, max_error: float = MAX_ERROR, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """The rows whose text holds no benchmark item, each judged by its own text; all columns."""
    for block in _blocks(benchmark, max_error, item_id_col, item_text_col):
        docs = docs.where(_free_of(block)(F.col(f"`{text_col}`").cast("string")))
    return docs


def _free_of(block):
    @F.pandas_udf("boolean")
    def free(texts: pd.Series) -> pd.Series:
        return pd.Series([not matches(block.value, t) for t in texts], dtype=bool)

    return free
