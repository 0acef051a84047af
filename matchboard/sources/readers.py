"""Table scans, incremental reads, file listings and records in JSON or CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import size_pretty
from ..schema import TABLES

# Text comes back as it was written: spaces at the ends, quotes and line breaks included. A missing value has a mark
# of its own, as the empty text is written as two quotes; text that looks like the mark gets one more backslash.
CSV_TEXT = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "nullValue": "\\N"}
LIKE_THE_MARK = r"^(\\+N)$"
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# Where the first run of each incremental read starts.
FIRST_LOAD = "2020-01-01 00:00:00"
FIRST_EXPORT = "1900-01-01 00:00:00"


def scan(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A base table from Parquet with its declared columns."""
    return spark.read.schema(TABLES[table]).parquet(path)


def jdbc_table(
    spark: SparkSession, url: str, table: str, column: str, lower: str, upper: str, parts: int, **options: str
) -> DataFrame:
    """A database table read in ``parts`` ranges of a column, instead of through one cursor."""
    ranged = {"partitionColumn": column, "lowerBound": lower, "upperBound": upper, "numPartitions": str(parts)}
    return spark.read.format("jdbc").options(url=url, dbtable=table, **ranged, **options).load()


def incremental(df: DataFrame, ts: str, low: Column, high: Column, closed: bool = False) -> DataFrame:
    """Rows in (low, high], or in [low, high] when ``closed``. Both bounds reach the Parquet scan."""
    after = F.col(ts) >= low if closed else F.col(ts) > low
    return df.filter(after & (F.col(ts) <= high))


def watermark_state(registry: DataFrame, default: str) -> DataFrame:
    """The newest watermark by id, one row; ``default`` when there is none."""
    newest = registry.agg(F.max_by("point_of_time", "id").alias("point_of_time"))
    kind = registry.schema["point_of_time"].dataType
    return newest.select(F.coalesce("point_of_time", F.lit(default).cast(kind)).alias("point_of_time"))


def watermark_advance(registry: DataFrame, loaded: DataFrame, ts: str) -> DataFrame:
    """The registry with one more row: the latest time that was loaded. Nothing loaded adds nothing.

    Taking the loaded maximum, not the clock, means that no row is skipped and none is read twice.
    """
    newest = loaded.agg(F.max(ts).alias("point_of_time")).filter(F.col("point_of_time").isNotNull())
    following = registry.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("id")).scalar()
    return registry.unionByName(newest.select(following.cast("long").alias("id"), "point_of_time"))


def bounded_extract(df: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows in a stated total order."""
    return df.orderBy(*order).limit(limit)


def lake_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, time and size of every file below a folder; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "modificationTime", "length")


def table_sizes(files: DataFrame, base: str) -> DataFrame:
    """Total and readable size per first folder below ``base``, by name."""
    folder = base.rstrip("/").rsplit("/", 1)[-1]
    name = F.substring_index(F.substring_index("path", f"/{folder}/", -1), "/", 1)
    sized = files.groupBy(name.alias("table_name")).agg(F.sum("length").alias("n_bytes"))
    return sized.withColumn("size", size_pretty("n_bytes")).orderBy("table_name")


def from_json_records(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """One row per record of a column that holds JSON records (one object, or an array of them)."""
    records = F.from_json(column, T.ArrayType(schema))
    return df.select(F.inline(records))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV export with header, as it was before it was written; a lost or added column is an error of the schema."""
    rows = spark.read.schema(schema).options(**CSV_TEXT, multiLine=True, timestampNTZFormat=ISO).csv(path)
    text = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    plain = {c: F.when(F.col(c).rlike(LIKE_THE_MARK), F.substring(c, 2, 2**31 - 1)).otherwise(F.col(c)) for c in text}
    return rows.withColumns(plain) if plain else rows


def read_csv_versions(spark: SparkSession, versions: Sequence[tuple[str, T.StructType]]) -> DataFrame:
    """CSV exports with header, each read by its own schema; a column a version lacks is NULL."""
    frames = [read_csv(spark, path, schema) for path, schema in versions]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
