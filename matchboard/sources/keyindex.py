"""Which files of a large Parquet table may hold a key: a key range per file and Bloom filters.

Filters are made where a file is read, one of at most ``KEYS_PER_FILTER`` keys after the other, so a task holds no
more than that of a file of any size; the keys themselves are not shuffled.

The index lies in ``_keys`` below the table, where no reader of the table looks. It may lag behind: files it does not
know are read whole, and entries of files that are gone are not asked. So a crash between a write and its entry, or
a file dropped by retention, changes no answer. A Bloom filter errs on one side only; a file named in vain is read
in vain.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cluster import fits

# task code travels with the task: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS_PER_KEY, PROBES = 24, 8  # about four keys in 100,000 are found where they are not
FEW_KEYS = 65_536  # more keys than that are hardly absent from any file; their range alone is asked
ROWS_PER_FILE = 2_000_000  # bounds what is read for one hit
KEYS_PER_FILTER = 1 << 18  # a filter of them takes 1 MB
KEYS_PER_PART = 1 << 24  # whose filters are one file of the index


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The places of each hash in a filter of ``bits`` places, a power of two; a row per hash."""
    whole = hashes.astype(np.uint64)
    step = (whole >> np.uint64(32)) | np.uint64(1)
    turns = np.arange(PROBES, dtype=np.uint64)
    return ((whole[:, None] + turns * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def bloom(hashes: np.ndarray) -> bytes:
    """A filter of these hashes."""
    bits = max(64, 1 << int(np.ceil(np.log2(max(1, len(hashes)) * BITS_PER_KEY))))
    held = np.zeros(bits, dtype=bool)
    held[_places(hashes, bits).ravel()] = True
    return np.packbits(held).tobytes()


def bloom_holds(filter_bytes: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes the filter may hold."""
    held = np.unpackbits(np.frombuffer(filter_bytes, dtype=np.uint8)).astype(bool)
    return held[_places(hashes, len(held))].all(axis=1)


def _filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Filters of the hashes in the second column, none of two files; a file's rows follow each other."""

    def made(file: int, held: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([file], pa.int64()), pa.array([bloom(np.concatenate(held))], pa.binary())], ["id", "bloom"])

    now, held, n = None, [], 0
    for batch in batches:
        files, hashes = (batch.column(i).to_numpy() for i in range(2))
        turns = np.flatnonzero(np.diff(files)) + 1
        for file, part in zip(files[np.append(0, turns)].tolist() if len(files) else [], np.split(hashes, turns)):
            while len(part):
                if n and (file != now or n == KEYS_PER_FILTER):
                    yield made(now, held)
                    held, n = [], 0
                now, room = file, KEYS_PER_FILTER - n
                held.append(part[:room])
                n, part = n + len(held[-1]), part[room:]
    if n:
        yield made(now, held)


class KeyIndex:
    """The index of a table at ``path`` by ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def _files(self) -> DataFrame:
        """The files of the table, by name; nothing is opened."""
        reader = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        # a scan of the file tells its own name in the second form
        return reader.load(self.path).select(F.col("path").alias("file"), F.xxhash64("_metadata.file_path").alias("id"))

    def _entries(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/_keys")
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return None

    def _unknown(self, files: DataFrame, entries: DataFrame | None) -> list:
        return (files if entries is None else files.join(entries.select("file"), "file", "left_anti")).collect()

    def refresh(self) -> int:
        """Add entries for files that have none; returns how many."""
        fresh = self._unknown(self._files(), self._entries())
        if not fresh:
            return 0

        rows = self.spark.read.parquet(*[r.file for r in fresh])
        keyed = rows.select(F.xxhash64("_metadata.file_path").alias("id"), F.col(self.key).alias("key"), F.xxhash64(self.key).alias("h"))
        per_file = keyed.groupBy("id").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("n"))
        listed = self.spark.createDataFrame(fresh, "file string, id long").join(per_file, "id", "left")
        known = self.spark.createDataFrame(listed.collect(), listed.schema)  # a row per file
        made = keyed.select("id", "h").mapInArrow(_filters, "id long, bloom binary").join(F.broadcast(known), "id")
        empty = known.where("n IS NULL").withColumn("bloom", F.lit(None).cast("binary"))  # a file without rows has no range
        entries = made.select("file", "low", "high", "bloom").union(empty.select("file", "low", "high", "bloom"))
        parts = 1 + len(fresh) // 1000 + known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // KEYS_PER_PART
        entries.repartition(parts).write.mode("append").parquet(f"{self.path}/_keys")
        return len(fresh)

    def files_with(self, keys: DataFrame) -> list[str]:
        """Files that may hold one of the keys in the first column of ``keys``."""
        try:
            files = self._files()
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return []
        entries = self._entries()
        unknown = [r.file for r in self._unknown(files, entries)]
        keys = keys.select(F.col(keys.columns[0]).alias("key")).where("key IS NOT NULL").distinct()
        bounds = keys.agg(F.min("key").alias("low"), F.max("key").alias("high")).first()
        if entries is None or bounds.low is None:
            return unknown
        near = entries.where((F.col("low") <= F.lit(bounds.high)) & (F.col("high") >= F.lit(bounds.low))).join(files, "file", "left_semi")
        if fits(keys, FEW_KEYS):
            asked = np.array([r[0] for r in keys.select(F.xxhash64("key")).collect()], dtype=np.int64)

            def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    hit = [bool(bloom_holds(b, asked).any()) for b in batch.column(1).to_pylist()]
                    yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(hit, pa.bool_()))], ["file"])

            near = near.select("file", "bloom").mapInArrow(holding, "file string")
        return unknown + [r.file for r in near.select("file").distinct().collect()]
