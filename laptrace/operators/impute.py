"""Filling missing marks.  Everything fitted is a small table keyed by feature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from laptrace.functions.events import baseline_seconds, feature_name
from laptrace.functions.lookups import by_age, hash_uniform
from laptrace.operators.joins import BROADCAST_ROWS, lookup_join
from laptrace.operators.quantiles import exact_median
from laptrace.vocab import (
    ADULT_AGES, BASELINE_FACTOR_DEFAULT, BASELINE_FACTORS, PROGRESSION_DEFAULT, PROGRESSION_FACTORS,
    YOUTH_AGES,
)


def jitter(value: Column, key: Column, spread: float, seed: int | None) -> Column:
    """Multiplies by 1 +- spread, drawn from a hash of the key; off without a seed."""
    if seed is None:
        return value
    return value * (F.lit(1 - spread) + hash_uniform(key, str(seed)) * F.lit(2 * spread))


def progression(best: DataFrame, eligible: DataFrame | None = None, *, seed: int | None = None,
                spread: float = 0.02) -> DataFrame:
    """Estimated youth marks: best adult time of the same athlete, event and course times the age factor.

    Only ages without a mark are filled.  One aggregation finds the adult best and the (at
    most nine) youth ages present, so no join back to the marks is needed.  ``eligible``
    restricts the result to features of a vocabulary (columns event, course, age).
    """
    age, mark = F.col("age"), F.col("time_seconds")
    per_event = best.where(mark.isNotNull()).groupBy("name", "event", "course").agg(
        F.min(F.when(age.between(*ADULT_AGES), mark)).alias("best_adult"),
        F.collect_set(F.when(age.between(*YOUTH_AGES), age)).alias("have"),
    ).where("best_adult is not null")
    filled = per_event.select(
        "name", "event", "course", "best_adult",
        F.explode(F.array_except(F.sequence(F.lit(YOUTH_AGES[0]), F.lit(YOUTH_AGES[1])), F.col("have"))).alias("age"),
    )
    if eligible is not None:
        # One feature can hold a large share of the rows, so this join is size-checked or salted.
        wanted = eligible.select("event", "course", "age").distinct()
        filled = lookup_join(filled, wanted, ["event", "course", "age"], "left_semi")
    factor = by_age(PROGRESSION_FACTORS, age, YOUTH_AGES[0], PROGRESSION_DEFAULT)
    key = F.concat_ws("|", "name", feature_name(F.col("event"), F.col("course"), age))
    return filled.withColumn("time_seconds", jitter(F.col("best_adult") * factor, key, spread, seed))


def baseline(features: DataFrame, *, seed: int | None = None, spread: float = 0.03) -> DataFrame:
    """Fill value of youth features nobody has a mark for: event baseline times the age factor.

    ``features`` is a vocabulary with ``event, course, age, feature, n_observed``.
    """
    empty = features.where((F.col("n_observed") == 0) & F.col("age").between(*YOUTH_AGES))
    factor = by_age(BASELINE_FACTORS, F.col("age"), YOUTH_AGES[0], BASELINE_FACTOR_DEFAULT)
    value = baseline_seconds(F.col("event")) * factor
    return empty.withColumn("fill", jitter(value, F.col("feature"), spread, seed))


def fit_medians(train: DataFrame, feature: str = "feature", value: str = "value",
                max_features: int | None = None) -> DataFrame:
    """Median per feature over the training rows only."""
    return exact_median(train, [feature], value, "median", max_groups=max_features)


def apply_medians(values: DataFrame, medians: DataFrame, feature: str = "feature", value: str = "value",
                  max_features: int | None = None) -> DataFrame:
    """Fills nulls in long form from fitted medians, one row per feature.

    With a proven bound on the features the medians are broadcast; otherwise they are measured first.
    """
    if max_features is not None and max_features <= BROADCAST_ROWS:
        joined = values.join(F.broadcast(medians), feature, "left")
    else:
        joined = lookup_join(values, medians, [feature])
    return joined.withColumn(value, F.coalesce(F.col(value), F.col("median"))).drop("median")
