"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchboard.cluster import new_folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and go on from the written copy.

    Later reads see the same rows even if executors are lost, and may prune columns and push filters.
    """
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def text_of(column: str) -> Column:
    """The text column; null counts as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
