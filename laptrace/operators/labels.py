"""Indicators and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from laptrace.functions.events import (
    event_label, feature_name, indicator_label, indicator_name, programme_key,
)
from laptrace.functions.lookups import by_age
from laptrace.functions.marks import is_valid_mark
from laptrace.vocab import NO_EVENT_LABEL, OPEN_THRESHOLD, PROGRAMME_EVENTS, THRESHOLDS, YOUTH_AGES


def programme_table(spark, events: list[str] | None = None) -> DataFrame:
    """The programme with its keys and indicator names; a constant of a few rows."""
    rows = spark.range(1).select(
        F.posexplode(F.array(*[F.lit(e) for e in (events or PROGRAMME_EVENTS)])).alias("pos", "programme_event"))
    return rows.select(
        "programme_event",
        programme_key(F.col("programme_event")).alias("programme_key"),
        indicator_name(F.col("programme_event")).alias("indicator"),
    )


def programme_entries(races: DataFrame, course: str = "LCM") -> DataFrame:
    """Races on the given course whose event is on the programme, matched on the exact event."""
    on_course = races.where(F.col("course") == course).withColumn("programme_key", programme_key(F.col("event_name")))
    return on_course.join(F.broadcast(programme_table(races.sparkSession)), "programme_key")


def entered(races: DataFrame) -> DataFrame:
    """Distinct (name, indicator) pairs: the long form of the indicator matrix."""
    return programme_entries(races).select("name", "indicator").distinct()


def indicator_columns(events: list[str] | None = None) -> list[str]:
    return sorted("Olympic_" + e.replace(" ", "_").replace("m", "m_") for e in (events or PROGRAMME_EVENTS))


def widen_indicators(names: DataFrame, pairs: DataFrame, key: str = "name") -> DataFrame:
    """One row per athlete with a 0/1 column per programme event."""
    columns = indicator_columns()
    flags = pairs.groupBy(key).agg(
        *[F.max((F.col("indicator") == c).cast("int")).alias(c) for c in columns])
    return names.join(flags, key, "left").fillna(0, subset=columns)


def events_entered(races: DataFrame) -> DataFrame:
    """Programme events per athlete as a sorted list with counts.

    Entries are counted per event first, so a list has at most one element per programme event.
    """
    counted = programme_entries(races).groupBy("name", "programme_event").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("name").agg(
        F.sort_array(F.collect_list(F.struct("programme_event", "n"))).alias("entries"),
        F.sum("n").alias("n_entries"),
    )


def any_indicator() -> Column:
    """Aggregate: is any indicator set anywhere?"""
    return F.coalesce(F.bool_or(F.col("indicator").isNotNull()), F.lit(False))


def threshold(label: Column, age: Column) -> Column:
    """Pass mark for a label at an age; open where the table has none."""
    out = F.lit(OPEN_THRESHOLD)
    for name, values in THRESHOLDS.items():
        out = F.when(label == name, by_age(values, age, YOUTH_AGES[0], OPEN_THRESHOLD)).otherwise(out)
    return out


def best_mark(best: DataFrame) -> DataFrame:
    """Each athlete's smallest valid time; on a tie the feature first in column order."""
    valid = best.where(is_valid_mark(F.col("time_seconds"))).withColumn(
        "feature", feature_name(F.col("event"), F.col("course"), F.col("age")))
    top = valid.groupBy("name").agg(
        F.min(F.struct("time_seconds", "feature", "event", "course", "age")).alias("top"))
    return top.select("name", "top.*")


def from_marks(names: DataFrame, best: DataFrame) -> DataFrame:
    """Label from performance: the event of the best mark if it meets the threshold.  ``names`` is unique."""
    judged = best_mark(best).withColumn("candidate", event_label(F.col("event")))
    judged = judged.withColumn("passes", F.col("time_seconds") <= threshold(F.col("candidate"), F.col("age")))
    return names.select("name").join(judged, "name", "left").withColumn(
        "label",
        F.when(F.col("candidate").isNotNull() & F.col("passes"), F.col("candidate")).otherwise(NO_EVENT_LABEL),
    )


def from_indicators(names: DataFrame, pairs: DataFrame) -> DataFrame:
    """Label from indicators: the first set one in column order (sorted names)."""
    first = pairs.groupBy("name").agg(F.min("indicator").alias("indicator"))
    return names.select("name").join(first, "name", "left").withColumn(
        "label", F.coalesce(indicator_label(F.col("indicator")), F.lit(NO_EVENT_LABEL)))


def label_athletes(names: DataFrame, best: DataFrame, pairs: DataFrame) -> DataFrame:
    """Indicators if any athlete has one, performance otherwise."""
    if pairs.agg(any_indicator().alias("any")).first()["any"]:
        return from_indicators(names, pairs).select("name", "label")
    return from_marks(names, best).select("name", "label")


def distribution(labelled: DataFrame, label: str = "label") -> DataFrame:
    return labelled.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
