"""Exports, snapshots and retention on any Hadoop path."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import datetime
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..cluster import cut_lineage
from ..functions import clean_text
from ..operators.skew import HOT_ROWS, hot_groups
from .readers import CSV_TEXT, ISO, LIKE_THE_MARK, lake_files

# task code travels with the task: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

def as_text(df: DataFrame) -> DataFrame:
    """Strings made valid for text formats; decimals as text so that no digit is lost."""
    columns = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            columns.append(clean_text(field.name).alias(field.name))
        elif isinstance(field.dataType, T.DecimalType):
            columns.append(F.col(field.name).cast("string").alias(field.name))
        else:
            columns.append(F.col(field.name))
    return df.select(*columns)


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partitions: tuple = ()) -> str:
    """Write one table as csv (with header), json (one record per line, ISO times) or parquet (snappy).

    With partitions, ``overwrite`` replaces the partitions that ``df`` has and leaves others alone.
    """
    target = df if fmt == "parquet" else as_text(df)
    if fmt == "csv":
        text = [f.name for f in target.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in partitions]
        target = target.withColumns({c: F.regexp_replace(c, LIKE_THE_MARK, r"\\$1") for c in text})
    writer = target.write.mode(mode).partitionBy(*partitions)
    if partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer.options(**CSV_TEXT).option("timestampNTZFormat", ISO).csv(path)
    elif fmt == "json":
        options = {"timestampFormat": ISO, "timestampNTZFormat": ISO, "ignoreNullFields": "false"}
        writer.options(**options).json(path)
    elif fmt == "parquet":
        writer.option("compression", "snappy").parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return path


# What the indexes of the original serve: (table, bucket columns, sort columns) per frequent query.
# Without bucket columns a table is stored in sorted ranges, for filters on the first sort column.
LAYOUTS: dict[str, tuple[str, tuple[str, ...], tuple[str, ...]]] = {
    "matches_by_tournament": ("matches", ("tournament_id", "team_a_id"), ("tournament_id", "team_a_id")),
    "stats_by_match": ("player_stats", ("match_id",), ("match_id", "player_id")),
    "stats_by_player": ("player_stats", ("player_id",), ("player_id", "match_id")),
    "payouts_by_player": ("prize_payouts", ("player_id",), ("player_id",)),
    "ratings_by_time": ("elo_history", (), ("changed_at", "player_id")),
}


def write_bucketed(
    df: DataFrame, name: str, path: str, keys: tuple, sort: tuple, buckets: int, min_rows: int = HOT_ROWS
) -> DataFrame:
    """A catalog table bucketed by ``keys``: joins, aggregates and windows on them need no shuffle.

    A bucket is read by one task, so a table with a hot key is not bucketed. It is stored in balanced
    sorted ranges instead, as is one without ``keys``; these let scans skip files by the sort columns.
    """
    if not keys or hot_groups(df, keys, min_rows):
        ranges = [F.asc(c) for c in dict.fromkeys([*sort, *df.columns])]
        writer = df.repartitionByRange(buckets, *ranges).sortWithinPartitions(*ranges).write.mode("overwrite")
    else:
        writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*sort)
    writer.option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def store_layout(tables, layout: str, name: str, path: str, buckets: int) -> DataFrame:
    """One of the ``LAYOUTS`` as a bucketed table. Buckets should come to some hundred MB each."""
    table, keys, sort = LAYOUTS[layout]
    return write_bucketed(tables[table], name, path, keys, sort, buckets)


def _date_parts(run_date: str) -> dict[str, Column]:
    """The columns of the folders of a date."""
    day = F.lit(run_date).cast("date")
    return {name: F.date_format(day, form) for name, form in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))}


def write_dated(df: DataFrame, base: str, run_date: str, fmt: str = "parquet") -> str:
    """Write below ``base/year=YYYY/month=MM/day=DD`` of the run date; a second run of a date replaces the first."""
    dated = df.select("*", *[part.alias(name) for name, part in _date_parts(run_date).items()])
    return write(dated, base, fmt, "overwrite", ("year", "month", "day"))


def read_dated(spark: SparkSession, base: str, run_date: str, schema: T.StructType) -> DataFrame:
    """The rows that ``write_dated`` has written as Parquet for a date; files of other dates are not read."""
    parts = _date_parts(run_date)
    stored = spark.read.schema(T.StructType([*schema.fields, *[T.StructField(name, T.StringType()) for name in parts]])).parquet(base)
    for name, part in parts.items():
        stored = stored.filter(F.col(name) == part)
    return stored.drop(*parts)


def stamped(path: str, moment: str) -> str:
    """``path_YYYY-MM-DD_HH-MM-SS`` for the start of a job."""
    return f"{path}_{datetime.fromisoformat(moment):%Y-%m-%d_%H-%M-%S}"


def snapshot(spark: SparkSession, tables: dict[str, DataFrame], base: str, moment: str) -> DataFrame:
    """Copy every table, gzip compressed, below one dated folder; returns table name and row count."""
    root = stamped(f"{base.rstrip('/')}/backup", moment)
    manifest = None
    for name, df in tables.items():
        path = f"{root}/{name}"
        df.write.mode("overwrite").option("compression", "gzip").parquet(path)
        counted = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"))  # from the file footers
        row = counted.select(F.lit(name).alias("table_name"), "n_rows")
        manifest = row if manifest is None else manifest.unionByName(row)
    return manifest


def retention_candidates(files: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    """Files last changed more than ``days`` before ``as_of``."""
    cutoff = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    return files.filter(F.col("modificationTime") < cutoff)


def retention_report(files: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    """Number and MB of expired files."""
    return retention_candidates(files, as_of, days).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.round(F.coalesce(F.sum("length"), F.lit(0)) / 1048576.0, 2).alias("mb"),
    )


def retention(spark: SparkSession, path: str, as_of: str, days: int = 90, dry_run: bool = True) -> DataFrame:
    """Expired files below ``path`` by folder, with their number and size; deletes them unless ``dry_run``.

    Only expired files are deleted. A folder goes when nothing but hidden markers is left below it. Tasks delete,
    each its part of one stored listing, and report what is gone; a task that is run again finds the same files
    gone and reports the same.
    """
    if not dry_run and days < 1:
        raise ValueError("keep at least one day")
    files = lake_files(spark, path).withColumn("folder", F.expr("left(path, length(path) - instr(reverse(path), '/'))"))
    if not dry_run:
        files = cut_lineage(files)  # one listing, taken before anything goes; the report outlives the files
    cutoff = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    expired = F.col("modificationTime") < cutoff
    folders = files.groupBy("folder").agg(
        F.count_if(expired).alias("n_files"),
        F.sum(F.when(expired, F.col("length")).otherwise(0)).alias("n_bytes"),
        F.every(expired).alias("whole"),  # the folder's own files, not those of folders below it
    )
    found = folders.filter(F.col("n_files") > 0)
    if dry_run:
        return found
    doomed = files.filter(expired).select("path", "folder", "length")
    gone = cut_lineage(doomed.hint("rebalance").mapInArrow(_delete_files, "folder string, length long"))
    emptied = found.filter("whole").select("folder").hint("rebalance").mapInArrow(_delete_empty_folders, "folder string")
    whole = cut_lineage(emptied).withColumn("whole", F.lit(True))  # after the files, as they are stored by now
    counted = gone.groupBy("folder").agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
    return counted.join(whole, "folder", "left").select("folder", "n_files", "n_bytes", F.coalesce("whole", F.lit(False)).alias("whole"))


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a Hadoop path, and the path in it."""
    scheme, rest = path.split(":", 1)
    rest = rest if rest.startswith("//") else f"//{rest}"  # Hadoop writes file:/folder
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + quote(rest))


def _delete_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, name = _place(path)
            folder, own = name.rsplit("/", 1)
            for file in (name, f"{folder}/.{own}.crc"):  # with its checksum, where there is one
                try:
                    system.delete_file(file)
                except FileNotFoundError:  # or gone, by an earlier run of this task
                    pass
        yield pa.RecordBatch.from_arrays(batch.columns[1:], ["folder", "length"])


def _delete_empty_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        empty = []
        for folder in batch.column(0).to_pylist():
            system, name = _place(folder)
            left = system.get_file_info(fs.FileSelector(name, allow_not_found=True))
            if all(info.is_file and info.base_name[0] in "_." for info in left):
                empty.append(folder)
                try:
                    system.delete_dir(name)
                except FileNotFoundError:  # by an earlier run of this task
                    pass
        yield pa.RecordBatch.from_arrays([pa.array(empty, pa.string())], ["folder"])


def _file_systems(spark: SparkSession):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return lambda path: path.getFileSystem(conf)


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether a path is one file; nothing is listed or opened."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return _file_systems(spark)(target).getFileStatus(target).isFile()


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all below it; nothing happens where there is none."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    _file_systems(spark)(target).delete(target, True)
