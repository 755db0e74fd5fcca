"""CSV and Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header and a declared schema: no pass over the data to guess types."""
    return spark.read.schema(schema).csv(path, header=True)


def write_csv(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    writer = df.write.option("header", True)
    (writer.partitionBy(*by) if by else writer).csv(path)


def write_split(df: DataFrame, path: str, split: str = "split") -> None:
    """Train and test matrices in one Parquet table, one folder per split, so a reader prunes to its own."""
    df.write.partitionBy(split).parquet(path)


def read_split(spark: SparkSession, path: str, which: str, split: str = "split") -> DataFrame:
    table = spark.read.parquet(path)
    return table.where(table[split] == which).drop(split)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Writes a frame to the shared folder and reads it back: short lineage that survives lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
