"""Line deduplication over levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at its ends and with A-Z in lower case. Keys of at least
``min_chars`` code points that ``min_docs`` documents hold lose all their lines, except in the document with the
largest id among them.

Documents come in batches of falling ids. A batch's line hashes (128 bits) are counted per key and merge-anti-joined
with every run: keys that a run has already decided need no further entry, because enough documents are counted and
the largest id came first. The rest becomes a run of its own, sorted and bucketed by the hash. Two runs of one level
are merged to one of the next level, so there are never more runs than the logarithm of the number of batches; as
runs share their buckets and order, neither the anti-join nor the merge shuffles them.

Null and empty texts are one empty line. Documents are told apart by id; rows without an id count as one document
that is smaller than all others. Rows that repeat an id count as one document, and each is judged as given. An empty
table gives an empty result. Columns other than id and text are never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchboard.cluster import new_folder
from matchboard.llm.common import stored, text_of

DIGEST = 16
HASH = ["h", "g"]  # the two halves of a digest


def line_key(line: bytes) -> bytes:
    return line.strip().lower()  # bytes: ASCII white space, and only A-Z


def _digest(key: bytes, min_chars: int) -> bytes | None:
    """The hash of a key that is long enough."""
    if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode()


def _line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """Rows (doc_id, text_hash, lines): the different line hashes of every row as an array of (h, g)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, digests = [0], []
            for text in batch.column(2).to_pylist():
                found = {_digest(line_key(line), min_chars) for line in _bytes(text).split(b"\n")} - {None}
                digests += found
                ends.append(len(digests))
            halves = np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
            pairs = pa.StructArray.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1])], HASH)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)], ["doc_id", "text_hash", "lines"]
            )

    rows = docs.select("doc_id", "text_hash", "text")
    return rows.mapInArrow(hashed, "doc_id long, text_hash long, lines array<struct<h: long, g: long>>")


class LineRuns:
    """Runs of (h, g, n_docs, last): how many documents hold a line, as far as counted, and the largest of them.

    Batches have to share no document and come in falling order of ids.
    """

    def __init__(self, spark, min_docs: int, buckets: int | None = None):
        self.spark, self.min_docs = spark, min_docs
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, DataFrame]]] = []

    def _write(self, rows: DataFrame, level: int) -> None:
        name, folder = f"line_run_{uuid.uuid4().hex}", new_folder(self.spark, "line-run")
        rows.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", folder).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, self.spark.table(name)))

    def add(self, lines: DataFrame) -> None:
        """Add a batch of rows (doc_id, h, g)."""
        # first per document, so that a line of very many documents is spread over tasks
        counts = lines.select("doc_id", *HASH).distinct().groupBy(*HASH).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last"))
        for _, run in self.runs():
            decided = run.where(F.col("n_docs") >= self.min_docs).select(*HASH)
            counts = counts.join(decided.hint("merge"), HASH, "left_anti")
        self._write(counts, 0)
        level = 0
        while len(self.levels[level]) == 2:
            self._merge(level)
            level += 1

    def runs(self) -> list[tuple[str, DataFrame]]:
        return [run for level in self.levels for run in level]

    def _merge(self, level: int, other: int | None = None) -> None:
        """Two runs become one of the next level."""
        a, b = self.levels[level].pop(), self.levels[level if other is None else other].pop()
        left, right = a[1].alias("a"), b[1].hint("merge").alias("b")
        merged = left.join(right, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in HASH], "full_outer").select(
            *[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in HASH],
            (F.coalesce("a.n_docs", F.lit(0)) + F.coalesce("b.n_docs", F.lit(0))).alias("n_docs"),
            F.greatest("a.last", "b.last").alias("last"),
        )
        self._write(merged, max(level, other or 0) + 1)
        for name, _ in (a, b):
            self.spark.sql(f"DROP TABLE {name}")  # its files stay, for tasks that are run again

    def frequent(self) -> DataFrame:
        """Rows (h, g, last) of lines in at least ``min_docs`` documents, read from one last run."""
        while len(self.runs()) > 1:
            low, high = [at for at, level in enumerate(self.levels) for _ in level][:2]
            self._merge(low, high)
        found = stored(self.runs()[0][1].where(F.col("n_docs") >= self.min_docs).select(*HASH, "last"), "frequent-lines")
        self.spark.sql(f"DROP TABLE {self.runs()[0][0]}")
        return found


def _batch_of(ids: DataFrame, batches: int):
    """Falling ranges of ids of about equal size; rows without an id come last."""
    shares = [i / batches for i in range(1, batches)]
    cuts = sorted(set(ids.approxQuantile("doc_id", shares, 0.01)), reverse=True) if shares else []
    passed = sum((F.col("doc_id") < F.lit(int(c))).cast("int") for c in cuts) if cuts else F.lit(0)
    return F.coalesce(passed, F.lit(len(cuts))).cast("int"), len(cuts) + 1


def deduplicate(
    docs: DataFrame, min_docs: int = 5, min_chars: int = 40, batches: int = 8, buckets: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (doc_id, text, n_lines, n_dropped), one per row of ``docs``; the text holds the lines that stay."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    batch, used = _batch_of(rows.select("doc_id"), batches)
    folder = new_folder(spark, "line-hashes")
    hashed = _line_hashes(rows, min_chars).select("doc_id", "text_hash", F.inline("lines"))
    hashed.withColumn("batch", batch).write.partitionBy("batch").parquet(folder)
    hashed = spark.read.schema("doc_id long, text_hash long, h long, g long, batch int").parquet(folder)
    runs = LineRuns(spark, min_docs, buckets)
    for at in range(used):
        runs.add(hashed.where(F.col("batch") == at).select("doc_id", *HASH))
    # a line's fate depends on its key and document alone; the text's hash only spreads rows of one id
    fated = hashed.join(runs.frequent(), HASH).where(~F.col("doc_id").eqNullSafe(F.col("last")))
    dropped = fated.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct(*HASH)).alias("gone"))
    known = dropped.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "gone")
    both = rows.join(known, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash")), "left")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            pairs, ends = lists.flatten(), np.concatenate(([0], np.cumsum(np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)))))
            digests = np.stack([pairs.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)], axis=1).astype(">i8").tobytes()
            texts, n_lines, n_dropped = [], [], []
            for text, low, high in zip(batch.column(1).to_pylist(), ends.astype(np.int64).tolist(), ends[1:].astype(np.int64).tolist()):
                if low == high:
                    texts.append(text)
                    n_lines.append(text.count("\n") + 1)
                    n_dropped.append(0)
                    continue
                gone = {digests[DIGEST * i : DIGEST * (i + 1)] for i in range(low, high)}
                lines = _bytes(text).split(b"\n")
                stay = [line for line in lines if _digest(line_key(line), min_chars) not in gone]
                texts.append(b"\n".join(stay).decode())
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                ["doc_id", "text", "n_lines", "n_dropped"],
            )

    return both.select("doc_id", "text", "gone").mapInArrow(kept, "doc_id long, text string, n_lines long, n_dropped long")
