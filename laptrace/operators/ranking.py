"""Exact ranks inside a group without bringing the group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from laptrace.session import fresh_path
from laptrace.sources.tables import materialise


def shuffled_rank(df: DataFrame, group: list[str], key: str, seed: int | str) -> DataFrame:
    """Adds ``rank`` (1..n in each group, in order of a seeded hash of the key) and ``group_rows``.

    A group is cut into 4096 slices by the first three hex digits of the hash.  Slices
    are counted, a running total over the at most 4096 counts of a group says where
    each slice starts, and only rows of one slice are sorted together.  Keys must be
    unique within a group.  Rows of a null group are a group of their own.
    """
    # a struct of nulls equals another one, so null groups survive the join
    hashed = df.withColumn("__g", F.struct(*group)).withColumn(
        "__h", F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    ).withColumn("__slice", F.substring("__h", 1, 3))
    running = Window.partitionBy("__g").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        hashed.groupBy("__g", "__slice").agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__start", F.coalesce(F.sum("__n").over(running), F.lit(0)))
        .withColumn("group_rows", F.sum("__n").over(Window.partitionBy("__g")))
        .drop("__n")
    )
    within = Window.partitionBy("__g", "__slice").orderBy("__h", key)
    return (
        hashed.withColumn("__r", F.row_number().over(within))
        .join(starts, ["__g", "__slice"])
        .withColumn("rank", F.col("__start") + F.col("__r"))
        .drop("__g", "__h", "__slice", "__start", "__r")
    )


def numbered(df: DataFrame, name: str, *order: str) -> DataFrame:
    """Adds the position of each row, from 0, in an order that tells all rows apart.

    Rows are dealt by range and written; a range starts behind the rows of those before it, so no task sees more
    than one range and nothing is gathered but a count for each.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(df.repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id()),
                         fresh_path(spark, "ranges"))
    ahead = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offsets = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n")).select(
        "__range", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return ranged.withColumn("__r", inside).join(F.broadcast(offsets), "__range").withColumn(
        name, F.col("__start") + F.col("__r") - 1).drop("__range", "__r", "__start")
