"""Grouping of spelling variants by reduced-alphabet generation.

Words are runs of letters (A-Z, a-z, U+00C0 to U+00FF) of whole texts, A-Z in lower case; one run in ``damage`` loses
a letter, as a hash of document and run decides. The vocabulary holds words of at least ``min_chars`` code points
met at least ``min_count`` times.

Letters are hashed to a few symbols. A word's reduced form and everything one inserted, deleted or replaced symbol
away from it are filed under 64-bit codes and joined with the vocabulary under the codes of its reduced forms: two
words one edit apart have reduced forms at most one edit apart, so no pair is missed. The original strings are
compared within the join, and only pairs one edit apart leave it. Every neighbourhood holds a code once, so a pair
is found once from each side. How many words meet under a code falls with the number of symbols, while a
neighbourhood grows with it.

Null texts have no words; a null id counts as the empty text in the hash. Rows and ids that repeat count as given.
Equal counts are told apart by code-point order. An empty table, or one without repeated words, gives an empty
result. Columns other than id and text are never read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchboard.llm.common import stored

HELD_WORDS = 200_000  # different words that a task counts before it passes them on
BASE = 0x9E3779B97F4A7C15  # of the codes; odd, so that it has an inverse among 64-bit numbers
TIMES_LARGER = 10  # a form is met at least so many times as often


def text_words(doc_id: int | None, text: str | None, min_chars: int, damage: int) -> Counter:
    """The words of one text with their numbers; equal runs of a document share their fate."""
    lowered = (text or "").encode().lower().decode()  # bytes: only A-Z
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    words = Counter()
    for run, n in Counter(re.findall(f"[A-Za-zÀ-ÿ]{{{min_chars},}}", lowered)).items():
        h = zlib.crc32(run.encode(), start)
        if h % damage == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < min_chars:
                continue
        words[run] += n
    return words


def vocabulary(docs: DataFrame, min_chars: int = 7, min_count: int = 2, damage: int = 31, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (word, n) over all texts; tasks count before anything is shuffled."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.update(text_words(doc_id, text, min_chars, damage))
                if len(held) >= HELD_WORDS:
                    yield out()
                    held.clear()
        yield out()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count)


def symbol(letter: str, symbols: int) -> int:
    return zlib.crc32(letter.encode() * 3) % symbols


def _reduced(words: list[str], symbols: int) -> np.ndarray:
    """A row of symbols, counted from one, per word; all words of one length."""
    points = np.array([[ord(c) for c in w] for w in words], dtype=np.int64).reshape(len(words), -1)
    letters, at = np.unique(points, return_inverse=True)
    of = np.array([symbol(chr(p), symbols) + 1 for p in letters], dtype=np.uint64)
    return of[at].reshape(points.shape)


def _powers(size: int) -> np.ndarray:
    return np.array([pow(BASE, i, 1 << 64) for i in range(size)], dtype=np.uint64)


def codes(words: list[str], symbols: int) -> np.ndarray:
    """A code per word of one length: the sum of its symbols times powers of ``BASE``, modulo 2**64."""
    reduced = _reduced(words, symbols)
    return (reduced * _powers(reduced.shape[1])).sum(axis=1, dtype=np.uint64)


def neighbourhoods(words: list[str], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the reduced words of one length and of all that is one edit away, each once, and whose they are."""
    reduced = _reduced(words, symbols)
    size = reduced.shape[1]
    power, inverse = _powers(size + 1), np.uint64(pow(BASE, -1, 1 << 64))
    before = np.zeros((len(words), size + 1), dtype=np.uint64)
    np.cumsum(reduced * power[:size], axis=1, out=before[:, 1:])
    whole = before[:, -1:]
    found = [whole, before[:, :-1] + (whole - before[:, 1:]) * inverse]  # itself; one symbol deleted
    for s in np.arange(1, symbols + 1, dtype=np.uint64):
        found.append(whole + (s - reduced) * power[:size])  # replaced
        found.append(before + s * power + (whole - before) * np.uint64(BASE))  # inserted
    every = np.sort(np.concatenate(found, axis=1), axis=1)
    fresh = np.ones(every.shape, dtype=bool)
    fresh[:, 1:] = every[:, 1:] != every[:, :-1]
    return every[fresh], np.nonzero(fresh)[0]


def _by_length(words: list[str]) -> dict[int, list[int]]:
    groups: dict[int, list[int]] = {}
    for at, word in enumerate(words):
        groups.setdefault(len(word), []).append(at)
    return groups


LETTERS_AT_ONCE = 50_000  # bounds the memory for neighbourhoods, of which a word has some ten codes a letter
ROWS_AT_ONCE = 50_000
SHORT = 64  # longer words are passed on by a hash, as a word goes with every code of its neighbourhood


def _filed(words: DataFrame, symbols: int, *columns: Column) -> DataFrame:
    """Rows (code, columns): the vocabulary under its reduced forms."""

    @F.pandas_udf("long")
    def code(column: pd.Series) -> pd.Series:
        given, out = column.tolist(), np.zeros(len(column), dtype=np.uint64)
        for places in _by_length(given).values():
            out[places] = codes([given[i] for i in places], symbols)
        return pd.Series(out.view(np.int64))

    return words.select(code("word").alias("code"), *columns)


def _asked(words: DataFrame, symbols: int, carried: str) -> DataFrame:
    """Rows (code, ``carried``): every word under the neighbourhood of its reduced form."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(0).to_pylist()
            for size, places in _by_length(given).items():
                step = max(1, LETTERS_AT_ONCE // size)
                for low in range(0, len(places), step):
                    part = places[low : low + step]
                    found, whose = neighbourhoods([given[i] for i in part], symbols)
                    own = batch.column(1).take(pa.array(part))
                    for at in range(0, len(found), ROWS_AT_ONCE):
                        piece = slice(at, at + ROWS_AT_ONCE)
                        yield pa.RecordBatch.from_arrays([pa.array(found[piece].view(np.int64)), own.take(pa.array(whose[piece]))], ["code", carried])

    kind = dict(words.dtypes)[carried]
    return words.select("word", F.col(carried).alias("carried")).mapInArrow(asked, f"code long, {carried} {kind}")


def near_words(words: DataFrame, symbols: int = 4) -> DataFrame:
    """Rows (word, near, near_n): all ordered pairs of words (word, n) one edit apart."""
    one_edit = F.levenshtein(F.col("word"), F.col("near"), 1) == 1
    length = F.char_length("word")
    short = words.where(length <= SHORT)
    filed = _filed(short, symbols, F.col("word").alias("near"), F.col("n").alias("near_n")).hint("shuffle_hash")
    among_short = _asked(short, symbols, "word").join(filed, "code").where(one_edit).select("word", "near", "near_n")
    # pairs that hold a longer word: hashes meet under the codes, and the words are fetched to be compared
    long = words.where(length >= SHORT).withColumn("id", F.xxhash64("word"))
    met = _asked(long, symbols, "id").join(_filed(long, symbols, F.col("id").alias("near_id")), "code").select("id", "near_id").distinct()
    named = met.join(long.select("id", "word"), "id").join(long.select(F.col("id").alias("near_id"), F.col("word").alias("near"), F.col("n").alias("near_n")), "near_id")
    among_long = named.where(one_edit & (length + F.char_length("near") > 2 * SHORT)).select("word", "near", "near_n")
    return among_short.union(among_long)


def _followed(forms: DataFrame) -> DataFrame:
    """Rows (word, root): the last form of every word that has a form. Steps double, and every step gains a factor."""
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("at"), F.col("root").alias("onward"))
        step = roots.join(onward, F.col("root") == F.col("at"), "left")
        moved = stored(step.select("word", F.coalesce("onward", "root").alias("root"), F.col("at").isNotNull().alias("moved")), "roots")
        roots = moved.select("word", "root")
        if not moved.where("moved").head(1):
            return roots


def variants(words: DataFrame, symbols: int = 4) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) for a vocabulary (word, n)."""
    words = stored(words, "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    nearest = near_words(words, symbols).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    known = nearest.select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"))
    large = F.col("form_n") >= TIMES_LARGER * F.col("n")
    formed = words.join(known, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), *[F.when(large, F.col(c)).alias(c) for c in ("form", "form_n")]
    )
    formed = stored(formed, "word-forms")
    roots = _followed(formed.where(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
