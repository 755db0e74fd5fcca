"""Incremental collection."""

from __future__ import annotations

from pyspark.sql import functions as F

from laptrace.plans import oracle as O
from laptrace.plans.registry import query
from laptrace.plans.source_queries import race_records
from laptrace.session import fresh_path
from laptrace.sources.records import write_json
from laptrace.streaming.ingest import ingest


@query("append_batches__h1_resume", f"""with {O.RACE_CTES}
  select name, event, course, time_seconds, strftime(race_day, '%Y-%m-%d') as race_day, meet_name from races""")
def resumed_ingest(spark, sf_dir):
    """Two batches of record files, collected by two runs; every record ends up in the table once."""
    base = fresh_path(spark, "ingest")
    records = race_records(spark, sf_dir)
    write_json(records.where("Course = 'LCM'"), f"{base}/in", mode="append")
    ingest(spark, f"{base}/in", f"{base}/races", f"{base}/checkpoint")
    write_json(records.where("Course <> 'LCM'"), f"{base}/in", mode="append")
    ingest(spark, f"{base}/in", f"{base}/races", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/races").select(
        "name", "event", "course", "time_seconds", F.date_format("race_day", "yyyy-MM-dd").alias("race_day"), "meet_name")
