"""The newest row of every key, as a stream leaves it from batch to batch.

Keys are split into parts by their hash. A batch adds its changed rows as one small run per part it touches; runs of
one level that grow too many are merged into one of the next level, part by part. So a batch writes what it changed,
every row is rewritten as often as there are levels, and parts without a change are not touched at all.

``manifest/batch=N`` lists the runs that make up the state after batch N. Batch N reads what batch N-1 left; that it
is missing is an error, as an empty state in its place would lose every key. A batch that is delivered again writes
the same runs again. Runs that were merged go when the batch after has begun, as nothing can ask for them any more.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import first_per_key
from ..sources.writers import drop_folder

MERGE_AT = 4  # runs of one level and part
_MANIFEST = "part int, level int, since long, run string, parts int"
_BATCH = "__batch"


@dataclass(frozen=True)
class Run:
    part: int
    level: int
    since: int  # the first batch it holds rows of
    run: str

    def path(self, folder: str) -> str:
        return f"{folder}/runs/{self.run}/part={self.part}"


class KeyedState:
    """Rows of ``schema`` by ``key`` below ``folder``. Take about as many parts as the state has hundreds of MB."""

    def __init__(self, spark: SparkSession, folder: str, key: str, schema: T.StructType, parts: int = 16):
        self.spark, self.folder, self.key, self.parts = spark, folder.rstrip("/"), key, parts
        self.columns = [f.name for f in schema.fields]
        self.stored = T.StructType([*schema.fields, T.StructField(_BATCH, T.LongType())])

    def _manifest(self, batch_id: int) -> str:
        return f"{self.folder}/manifest/batch={batch_id}"

    def runs(self, batch_id: int) -> list[Run]:
        """The runs of the state after a batch; before the first batch there are none."""
        if batch_id < 0:
            return []
        try:
            rows = self.spark.read.schema(_MANIFEST).parquet(self._manifest(batch_id)).collect()
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            raise ValueError(f"the state of batch {batch_id} is missing in {self.folder}") from missing
        if any(r.parts != self.parts for r in rows):
            raise ValueError(f"the state in {self.folder} has {rows[0].parts} parts, not {self.parts}")
        return sorted((Run(r.part, r.level, r.since, r.run) for r in rows), key=lambda r: (r.part, r.since))

    def _part(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int")

    def _read(self, runs: list[Run]) -> DataFrame:
        """The newest row per key of some runs, with the batch that wrote it."""
        if not runs:
            return self.spark.createDataFrame([], self.stored)
        rows = self.spark.read.schema(self.stored).parquet(*[r.path(self.folder) for r in runs])
        once = len({r.part for r in runs}) == len(runs)  # a run holds a key once
        return rows if once else first_per_key(rows, [self.key], [F.desc(_BATCH)])

    def rows(self, batch_id: int) -> DataFrame:
        """The whole state after a batch."""
        return self._read(self.runs(batch_id)).select(*self.columns)

    def rows_of(self, keys: DataFrame, batch_id: int) -> DataFrame:
        """The rows of some keys after a batch, read from the parts of these keys alone."""
        wanted = keys.select(self.key).distinct()
        touched = {r[0] for r in wanted.select(self._part()).distinct().collect()}  # no more than there are parts
        found = self._read([r for r in self.runs(batch_id) if r.part in touched])
        return found.join(wanted, self.key, "left_semi").select(*self.columns)

    def _write(self, rows: DataFrame, run: str) -> set[int]:
        """Write rows as one run and return the parts it has."""
        path = f"{self.folder}/runs/{run}"
        split = rows.withColumn("part", self._part()).hint("rebalance", "part")
        split.write.mode("overwrite").partitionBy("part").parquet(path)
        written = self.spark.read.schema(T.StructType([*self.stored.fields, T.StructField("part", T.IntegerType())]))
        return {r[0] for r in written.parquet(path).select("part").distinct().collect()}

    def put(self, batch_id: int, changed: DataFrame) -> None:
        """Replace the rows of the keys in ``changed``, which has each key once, in the name of a batch."""
        before = self.runs(batch_id - 1)
        rows = changed.select(*self.columns, F.lit(batch_id).cast("long").alias(_BATCH))
        delta = [Run(part, 0, batch_id, f"delta-{batch_id}") for part in self._write(rows, f"delta-{batch_id}")]
        now, merging = [], {}
        for part in {r.part for r in before + delta}:
            kept = [r for r in before + delta if r.part == part]
            level, due = 0, []
            while len(same := [r for r in kept if r.level == level]) + bool(due) >= MERGE_AT:
                due, kept = same + due, [r for r in kept if r.level != level]
                level += 1
            now += kept
            if due:
                merging[part] = (level, due)
        if merging:
            run = f"merged-{batch_id}"
            self._write(self._read([r for _, due in merging.values() for r in due]), run)
            now += [Run(part, level, min(r.since for r in due), run) for part, (level, due) in merging.items()]
        manifest = [(r.part, r.level, r.since, r.run, self.parts) for r in now]
        self.spark.createDataFrame(manifest, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(self._manifest(batch_id))
        if batch_id >= 2:
            self._forget(batch_id - 2, before)

    def _forget(self, batch_id: int, used: list[Run]) -> None:
        """Drop what only the state after an old batch is made of."""
        try:
            old = self.runs(batch_id)
        except ValueError:  # dropped when this batch was delivered before
            return
        for run in set(old) - set(used):
            drop_folder(self.spark, run.path(self.folder))
        drop_folder(self.spark, self._manifest(batch_id))

    def newest(self) -> int:
        """The last batch that left a state."""
        kept = self.spark.read.option("basePath", f"{self.folder}/manifest").parquet(f"{self.folder}/manifest")
        return kept.agg(F.max("batch")).first()[0]  # of at most three manifests
