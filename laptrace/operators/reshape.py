"""Long and wide form, vocabularies, column-set rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from laptrace.functions.events import feature_name, feature_parts, standard_feature
from laptrace.functions.lookups import once
from laptrace.operators.scoring import dense
from laptrace.vocab import COURSES, STRUCTURAL_EVENTS, YOUTH_AGES

YOUTH_PATTERN = "Age(" + "|".join(str(a) for a in range(YOUTH_AGES[0], YOUTH_AGES[1] + 1)) + ")"
# Columns a wide table or a model may have; more are an error, none is left out.
MAX_FEATURES = 20_000


def structural_features(spark: SparkSession, events: list[str] | None = None, courses: list[str] | None = None,
                        ages: tuple[int, int] = YOUTH_AGES) -> DataFrame:
    """Every event, course and age combination, from constant lists."""

    def each(values: list, name: str):
        return F.explode(F.array(*[F.lit(v) for v in values])).alias(name)

    grid = spark.range(1).select(each(events or STRUCTURAL_EVENTS, "event"))
    grid = grid.select("event", each(courses or COURSES, "course"))
    grid = grid.select("event", "course", F.explode(F.sequence(F.lit(ages[0]), F.lit(ages[1]))).alias("age"))
    return grid.withColumn("feature", feature_name(F.col("event"), F.col("course"), F.col("age")))


def vocabulary(best: DataFrame) -> DataFrame:
    """Structural features and those seen in the data, with the number of observed values."""
    seen = best.groupBy("event", "course", "age").agg(F.count("time_seconds").alias("n_observed"))
    seen = seen.withColumn("structural", F.lit(0))
    fixed = structural_features(best.sparkSession).select(
        "event", "course", "age", F.lit(0).cast("long").alias("n_observed"), F.lit(1).alias("structural"))
    both = seen.unionByName(fixed).groupBy("event", "course", "age").agg(
        F.sum("n_observed").alias("n_observed"), F.max("structural").alias("structural"))
    return both.withColumn("feature", feature_name(F.col("event"), F.col("course"), F.col("age")))


def add_feature(best: DataFrame) -> DataFrame:
    return best.withColumn("feature", feature_name(F.col("event"), F.col("course"), F.col("age")))


def all_features(best: DataFrame, max_features: int = MAX_FEATURES) -> list[str]:
    """Names of all structural and all observed features, sorted; a longer list than the bound is an error."""
    found = vocabulary(best).select("feature").limit(max_features + 1).collect()
    if len(found) > max_features:
        raise ValueError(f"more than {max_features} features")
    return sorted(r["feature"] for r in found)


def wide_rows(best: DataFrame, key: str = "name") -> DataFrame:
    """One row per key with all its times as a map from feature to time.

    Every observed feature is there; the width of a row is bounded by the features, not by the marks.
    """
    one = add_feature(best).groupBy(key, "feature").agg(F.min("time_seconds").alias("time_seconds"))
    return one.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("feature", "time_seconds"))).alias("times"))


def times_text(times: F.Column) -> F.Column:
    """A row's times in feature order, as text."""
    entries = F.transform(F.map_entries(times), lambda e: F.concat(
        e["key"], F.lit("="), F.format_string("%.2f", e["value"])))
    return F.coalesce(F.array_join(F.array_sort(entries), ";"), F.lit(""))


def lengthen_rows(wide: DataFrame, key: str = "name") -> DataFrame:
    """Back from maps to one row per time, the feature name taken apart."""
    long = wide.select(key, F.explode("times").alias("feature", "time_seconds"))
    return long.withColumns(feature_parts(F.col("feature")))


def missing_profile(best: DataFrame, rows: int) -> DataFrame:
    """Values and gaps of every structural and observed feature among ``rows`` rows; no pivot."""
    return vocabulary(best).select("feature", "n_observed", (F.lit(rows) - F.col("n_observed")).alias("n_missing"))


def widen(best: DataFrame, features: list[str], key: str = "name") -> DataFrame:
    """One row per key, one column per feature of the given list; unseen features are all null.

    A key is grouped as the list of what it gives, and is as wide as the features only after that, row by row; a
    pivot would hold the whole width of every key of a task at once.  Keys without any of the features are left out.
    """
    places = best.sparkSession.range(1).select(
        F.posexplode(F.split(F.lit("\n".join(features)), "\n")).alias("position", "feature"))
    placed = add_feature(best).join(F.broadcast(places), "feature")  # at most as many rows as the result has columns
    pairs = placed.groupBy(key).agg(F.array_sort(F.collect_list(
        F.struct("position", F.col("time_seconds").isNull().alias("no"), F.col("time_seconds").alias("value")))).alias("given"))
    # of a feature's times the first is the smallest
    one = pairs.withColumn("given", once(F.col("given"), lambda g: F.filter(
        g, lambda p, i: (i == 0) | (F.get(g, i - 1)["position"] != p["position"]))))
    nothing = F.array_repeat(F.lit(None).cast("double"), len(features))
    wide = one.select(key, F.explode(F.array(once(F.col("given"), lambda g: dense(g, nothing, len(features))))).alias("cells"))
    return wide.selectExpr(f"`{key}`", *[f"cells[{i}] as `{f}`" for i, f in enumerate(features)])


def lengthen(wide: DataFrame, key: str, features: list[str]) -> DataFrame:
    """Back to one row per observed value, the feature name taken apart."""
    # one array and one constant for the names, whatever their number; no projection per column
    names = F.split(F.lit("\n".join(features)), "\n")
    cells = wide.select(key, F.posexplode(F.array(*[F.col(f"`{f}`") for f in features])).alias("place", "time_seconds"))
    long = cells.where("time_seconds is not null").select(
        key, F.element_at(names, F.col("place") + 1).alias("feature"), "time_seconds")
    return long.withColumns(feature_parts(F.col("feature")))


def attach_wide(athletes: DataFrame, wide: DataFrame, athlete_key: str, key: str) -> DataFrame:
    """Athletes with their wide times; athletes without a race keep nulls.  Both sides have one row per key."""
    return athletes.join(wide.withColumnRenamed(key, athlete_key), athlete_key, "left")


def ordered_columns(columns: list[str], lead: list[str], tail: list[str],
                    indicator_prefix: str = "Olympic_", time_mark: str = "FastestTime") -> list[str]:
    """Output order: lead columns, sorted indicators, sorted time features, tail columns."""
    present = set(columns)
    flags = sorted(c for c in columns if c.startswith(indicator_prefix))
    times = sorted(c for c in columns if time_mark in c)
    return [c for c in lead if c in present] + flags + times + [c for c in tail if c in present]


def standard_names(features: DataFrame, feature: str = "feature", ordinal: str = "ordinal") -> DataFrame:
    """Which source feature feeds each standard name: of colliding ones, the first in column order."""
    return (
        features.withColumn("standard", standard_feature(F.col(feature)))
        .groupBy("standard").agg(F.min_by(feature, ordinal).alias(feature), F.count(F.lit(1)).alias("n_sources"))
    )


def rename_standard(wide: DataFrame) -> DataFrame:
    """Wide form of the same rule, over the column list alone."""
    import re

    from laptrace.vocab import STROKE_NAMES

    strokes = "|".join(sorted({*STROKE_NAMES.values(), "Free"}, key=len, reverse=True))
    kept: dict[str, str] = {}
    for column in wide.columns:
        kept.setdefault(re.sub(rf"m({strokes})", r"\1", column), column)
    return wide.select(*[F.col(source).alias(name) for name, source in kept.items()])


def observed_counts(wide: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column with its number of values and of gaps; a single pass over the data."""
    totals = wide.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(c).alias(c) for c in columns])
    return totals.unpivot(["__rows"], columns, "feature", "n_observed").select(
        "feature", "n_observed", (F.col("__rows") - F.col("n_observed")).alias("n_missing"))


def drop_empty(wide: DataFrame, columns: list[str], protected: str = YOUTH_PATTERN) -> DataFrame:
    """Drops columns without any value unless their name matches the protected pattern."""
    import re

    counts = wide.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    gone = [c for c in columns if counts[c] == 0 and not re.search(protected, c)]
    return wide.drop(*gone)


def used_features(features: DataFrame, protected: str = YOUTH_PATTERN) -> DataFrame:
    """Long form of the same rule over a vocabulary with ``n_observed``."""
    return features.where((F.col("n_observed") > 0) | F.col("feature").rlike(protected))
