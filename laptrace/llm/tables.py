"""Reading the input tables and keeping intermediates in the shared folder."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql import types as T

from laptrace.session import fresh_path

#: Estimates above this many bytes stand for plans Spark knows nothing about.
UNKNOWN = 1 << 50
#: Characters between words: blank and the five ASCII control blanks.
BLANKS = r"\x20\x09-\x0D"
WORD = rf"[^{BLANKS}]+"


def reachable(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it.

    A cluster whose executors do not share that folder gets the package with --py-files.
    """
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH")]))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Hands a worker's freed memory back to the machine: workers stay for the tasks of later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(run: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that ends its task with :func:`give_back`."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped


def partitions(df: DataFrame, mb_each: int = 16, measured: bool = False) -> int:
    """Partitions for a shuffle of whole texts: the session's number, or more if the input is large.

    The size is the optimizer's estimate, for files the bytes on disk; it bounds what one task holds.
    Where the plan has no usable estimate, or if asked to, the strings are measured in one pass.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if measured or size > UNKNOWN:
        texts = [f.name for f in df.schema.fields if f.dataType == T.StringType()]
        size = df.select(sum((F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) for c in texts), F.lit(0)).alias("n")).agg(
            F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, size // (mb_each << 20))


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def summed_before(df: DataFrame, name: str, value: Column, *order: Column) -> DataFrame:
    """Adds the sum of a whole-numbered ``value`` over all rows before each one, in the given total order.

    Ranges as in :func:`numbered`: a task sums within one range, ranges start from the sums of those before.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(df.withColumn("value_", value).repartitionByRange(parts, *order).withColumn(
        "range_", F.spark_partition_id()), "ranges")
    earlier = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("range_").agg(F.sum("value_").alias("all_")).select(
        "range_", F.coalesce(F.sum("all_").over(earlier), F.lit(0)).alias("offset_"))
    above = Window.partitionBy("range_").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("value_").over(above), F.lit(0))
    return (ranged.withColumn("inside_", inside).join(offsets, "range_")
            .withColumn(name, F.col("offset_") + F.col("inside_")).drop("range_", "value_", "inside_", "offset_"))


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Adds the position of each row, from 1, in the given total order.

    Rows are dealt by range and stored, positions run within each range and start behind the rows
    of the ranges before, so no task sees more than one range.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(df.repartitionByRange(parts, *order).withColumn("range_", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("range_").agg(F.count("*").alias("rows_"))
    before = F.coalesce(F.sum("rows_").over(Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0))
    offsets = counts.select("range_", before.alias("before_"))
    inside = F.row_number().over(Window.partitionBy("range_").orderBy(*order))
    return (ranged.withColumn("inside_", inside).join(offsets, "range_")
            .withColumn(name, F.col("before_") + F.col("inside_")).drop("range_", "before_", "inside_"))
