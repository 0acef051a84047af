"""SimHash near-duplicates by multi-index hashing.

A fingerprint of 64 bits is cut into segments. Two fingerprints that differ in at most r bits differ in at
most r // segments bits within one segment at least, so it is enough to enumerate the small Hamming ball of
each segment, fetch the fingerprints filed under those segment values, and verify the complete distance.
Equal fingerprints are one entry of the index, so copies of a text never form pairs; a fingerprint has a
bounded number of others within the distance, and only verified links leave the join.

Null and empty texts have fingerprint zero and are linked like any other. Rows with a null id are
fingerprinted too; a component made only of such rows has a null id. Repeated rows appear as often as given.
An empty table gives an empty result. Columns other than the id and the text are never read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchboard.llm.common import stored
from matchboard.llm.graph import components

BITS = 64
HASH_SEED = 42
SHINGLES_AT_ONCE = 1 << 16  # bounds the memory for a very long text


def fingerprint(text: str | None, shingle: int) -> int:
    """Unsigned 64-bit SimHash of the ``shingle``-word shingles, repeats included."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(words) - shingle + 1)
    last = (ends - 1)[min(shingle, len(words)) - 1 :]
    counts = np.zeros(BITS, dtype=np.int64)
    for low in range(0, n, SHINGLES_AT_ONCE):
        spans = zip(starts[low : min(n, low + SHINGLES_AT_ONCE)].tolist(), last[low : low + SHINGLES_AT_ONCE].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], HASH_SEED) for a, b in spans], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (doc_id, fp) and the columns ``keep``: the fingerprint of every row as a signed long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), of(F.col(text_col).cast("string")).alias("fp"), *keep)


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _masks(width: int, radius: int) -> list[int]:
    """Up to ``radius`` bits out of ``width``."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def links(prints: DataFrame, max_distance: int = 3, segments: int = 2) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints ``fp`` that differ in at most ``max_distance`` bits.

    Of two values a few bits apart one becomes the other by clearing at least as many bits as it sets, so half of
    each ball is enough. Both sides are shuffled whatever their size, as a ball has many times the rows of its table.
    """
    bounds = [BITS * i // segments for i in range(segments + 1)]
    radius = max_distance // segments
    segment = [F.shiftrightunsigned("fp", low).bitwiseAND(F.lit(_signed((1 << (high - low)) - 1)).cast("long")) for low, high in zip(bounds, bounds[1:])]
    filed = F.array(*[F.struct(F.lit(at).alias("segment"), value.alias("value")) for at, value in enumerate(segment)])
    flips = F.array(
        *[F.struct(F.lit(at).alias("segment"), F.lit(_signed(m)).cast("long").alias("flip")) for at, (low, high) in enumerate(zip(bounds, bounds[1:])) for m in _masks(high - low, radius)]
    )
    table = prints.select(F.col("fp").alias("a"), F.explode(filed).alias("at")).select("at.*", "a")
    own = F.get(F.array(*segment), F.col("at.segment"))
    asked = prints.select("fp", F.explode(flips).alias("at")).select(F.col("fp").alias("b"), "at.*", own.alias("own"))
    half = asked.where(F.bit_count(F.col("own").bitwiseAND(F.col("flip"))) * 2 >= F.bit_count("flip"))
    probes = half.select("segment", F.col("own").bitwiseXOR(F.col("flip")).alias("value"), "b").hint("merge")
    near = (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)
    met = table.join(probes, ["segment", "value"]).where(near)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _named(classes: DataFrame, max_distance: int, segments: int) -> DataFrame:
    """Rows (fp, least, root) of distinct fingerprints; root is the same in a whole component."""
    found = components(links(classes.select("fp"), max_distance, segments))
    named = classes.join(found, classes.fp == found.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return stored(named, "simhash-classes")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_distance: int = 3, segments: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (doc_id, fp, component_id), one per row of ``docs``.

    component_id is the smallest id that can be reached over links, the row's own included.
    """
    rows = stored(fingerprints(docs, shingle, id_col, text_col), "simhash")
    named = _named(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), max_distance, segments)
    grouped = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(grouped, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def representatives(
    docs: DataFrame, key: tuple[str, ...], shingle: int = 3, max_distance: int = 3, segments: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (key columns), one per component: the row with the smallest id, null ids last, then the smallest key."""
    rows = fingerprints(docs, shingle, id_col, text_col, key)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", *key)).alias("least")
    named = _named(stored(rows.groupBy("fp").agg(least), "simhash"), max_distance, segments)
    return named.groupBy("root").agg(F.min("least").alias("least")).select(*[F.col(f"least.{k}") for k in key])


def hex_print(name: str):
    """16 lowercase hexadecimal digits of a signed long."""
    return F.lpad(F.lower(F.hex(F.col(name))), 16, "0")
