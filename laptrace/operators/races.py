"""Race records: parsing, age at the race, best marks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from laptrace.functions.dates import completed_years, race_date
from laptrace.functions.events import event_key, is_individual
from laptrace.functions.marks import seconds
from laptrace.operators.joins import fits_broadcast, salted_join
from laptrace.vocab import ADULT_AGES

KEYS = ["name", "event", "course", "age"]


def parse(raw: DataFrame) -> DataFrame:
    """Text columns ``event_name, race_date, time_text`` to event key, date and seconds; row by row, no shuffle."""
    return raw.withColumns({
        "event": event_key(F.col("event_name")),
        "race_day": race_date(F.col("race_date")),
        "time_seconds": seconds(F.col("time_text")),
    })


def individual(races: DataFrame) -> DataFrame:
    return races.where(is_individual(F.col("event_name")))


def with_age(races: DataFrame, births: DataFrame, measured: DataFrame | None = None) -> DataFrame:
    """Adds the birth date and the age on the day; races of unknown athletes stay, without an age.

    ``births`` has one row per ``name`` with column ``born``.
    """
    if fits_broadcast(births if measured is None else measured):
        joined = races.join(F.broadcast(births), "name", "left")
    else:
        joined = salted_join(races, births, ["name"], "left")
    return joined.withColumn("age", completed_years(F.col("born"), F.col("race_day")))


def fastest(races: DataFrame, births: DataFrame, measured: DataFrame | None = None) -> DataFrame:
    """Best time per athlete, event, course and age over individual races.

    With a small athlete side the facts are joined in place and shuffled once, combined
    first.  With a large one they are reduced to one row per athlete, event, course and
    day before the join, so repeats and frequent athletes do not reach it.
    """
    slim = individual(races).select("name", "event", "course", "race_day", "time_seconds")
    if not fits_broadcast(births if measured is None else measured):
        slim = (
            slim.where("name is not null and course is not null and race_day is not null")
            .groupBy("name", "event", "course", "race_day").agg(F.min("time_seconds").alias("time_seconds"))
        )
        aged = salted_join(slim, births, ["name"], "left").withColumn(
            "age", completed_years(F.col("born"), F.col("race_day")))
    else:
        aged = slim.join(F.broadcast(births), "name", "left").withColumn(
            "age", completed_years(F.col("born"), F.col("race_day")))
    # A test on the age before the aggregate would be pushed down to the facts and parse every date a
    # second time there; the event key is never null.
    known = aged.where("name is not null and course is not null")
    best = known.groupBy(*KEYS).agg(F.min("time_seconds").alias("time_seconds"), F.count("age").alias("aged"))
    return best.where("aged > 0").drop("aged")


def adult_best(best: DataFrame, ages: tuple[int, int] = ADULT_AGES) -> DataFrame:
    """Best adult time per athlete, event and course."""
    return (
        best.where(F.col("age").between(*ages) & F.col("time_seconds").isNotNull())
        .groupBy("name", "event", "course").agg(F.min("time_seconds").alias("best_adult"))
    )
