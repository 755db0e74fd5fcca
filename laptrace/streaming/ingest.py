"""Picks up record files as they arrive and appends parsed races to a table.

The checkpoint remembers which files are done, so a restart goes on where the last run
stopped and no file is read twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from laptrace.operators.races import parse
from laptrace.sources.records import RACE_SCHEMA, judged


def all_records(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of race records from JSON Lines files of a folder, what does not parse in ``_corrupt_record``."""
    return (
        spark.readStream.schema(RACE_SCHEMA + ", _corrupt_record string")
        .option("columnNameOfCorruptRecord", "_corrupt_record").json(folder)
    )


def new_records(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of well-formed race records."""
    return all_records(spark, folder).where("_corrupt_record is null").drop("_corrupt_record")


def parsed(records: DataFrame) -> DataFrame:
    """Record layout to the names of the race table, with event key and date; works on streams and tables."""
    named = records.select(
        F.col("Swimmer_ID").alias("name"), F.col("Race_Date").alias("race_date"), F.col("Event_Name").alias("event_name"),
        F.col("Course").alias("course"), F.col("Time_Seconds").cast("string").alias("time_text"),
        F.col("Meet_Name").alias("meet_name"), F.col("Meet_URL").alias("meet_url"))
    return parse(named).drop("time_text", "race_date")


def ingest(spark: SparkSession, folder: str, table: str, checkpoint: str) -> None:
    """Appends the races of all files not seen before to a Parquet table, then stops."""
    query = (
        parsed(new_records(spark, folder)).writeStream.format("parquet")
        .option("path", table).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def sort_out(spark: SparkSession, folder: str, table: str, checkpoint: str, reasons: dict[str, Column] | None = None) -> None:
    """Appends all records of new files to a Parquet table, good and rejected in a folder each, then stops."""
    query = (
        judged(all_records(spark, folder), reasons).writeStream.format("parquet").partitionBy("status")
        .option("path", table).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
