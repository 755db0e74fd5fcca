"""JSON records and name lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# fixed values: record layouts
RACE_SCHEMA = (
    "Swimmer_ID string, Race_Date string, Event_Name string, Course string, Time_Seconds double, "
    "Meet_Name string, Meet_URL string"
)
ATHLETE_SCHEMA = (
    "name string, dob string, height_cm double, weight_kg double, gender string, race string, "
    "paris_2024_races array<string>, error string"
)


def read_json(spark: SparkSession, path: str, schema: str, *, array_file: bool = False) -> DataFrame:
    """Records with a declared schema; text that does not parse is kept in ``_corrupt_record``.

    JSON Lines splits over tasks.  A file that is one JSON array does not, so
    ``array_file`` is for the small exchange files only.
    """
    return (
        spark.read.schema(schema + ", _corrupt_record string").option("multiLine", array_file)
        .option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    )


def well_formed(records: DataFrame) -> DataFrame:
    return records.where("_corrupt_record is null").drop("_corrupt_record")


def judged(records: DataFrame, reasons: dict[str, Column] | None = None) -> DataFrame:
    """Adds ``status`` (good or rejected), ``reason`` and ``raw``, for tables and streams of :func:`read_json`.

    A text that does not parse is rejected as unreadable, others for the first of the ``reasons`` whose condition
    holds; a condition that is null does not.  ``raw`` is the text as it was read, or the record as JSON; good records have none.
    """
    reason = F.when(F.col("_corrupt_record").isNotNull(), "unreadable")
    for name, condition in (reasons or {}).items():
        reason = reason.when(condition, name)
    fields = [c for c in records.columns if c != "_corrupt_record"]
    raw = F.coalesce("_corrupt_record", F.to_json(F.struct(*fields)))
    return records.withColumn("reason", reason).withColumns({
        "raw": F.when(F.col("reason").isNotNull(), raw),
        "status": F.when(F.col("reason").isNull(), "good").otherwise("rejected")}).drop("_corrupt_record")


def write_judged(records: DataFrame, path: str) -> None:
    """Good and rejected records in one pass, a folder each, so that a reader of one never opens the other."""
    records.write.partitionBy("status").parquet(path)


def read_judged(spark: SparkSession, path: str, schema: str, status: str) -> DataFrame:
    """The good records with their fields, or the rejected ones with reason and raw text."""
    table = spark.read.schema(f"{schema}, reason string, raw string, status string").parquet(path).where(F.col("status") == status)
    return table.drop("status", "reason", "raw") if status == "good" else table.select("reason", "raw")


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON Lines, nulls kept as fields, one file per task."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """Name list: one per line, trimmed, blank lines dropped."""
    trimmed = spark.read.text(path).select(F.regexp_replace("value", r"(?U)^\s+|\s+$", "").alias("name"))
    return trimmed.where(F.length("name") > 0)


def write_names(names: DataFrame, path: str, column: str = "name") -> None:
    """Sorted distinct names, one per line; sorting is by range over the tasks."""
    names.select(F.col(column).alias("value")).distinct().orderBy("value").write.text(path)
