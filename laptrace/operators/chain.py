"""The whole imputation of a split wide table, in long form.

A missing cell gets, in this order, the athlete's own estimate (youth ages, from their best adult mark), the median
of the feature over the training rows, or for a youth feature without any training value its baseline.  A
feature that has none of these is left out.  Filled cells are never rows: a feature has one fill, and only
what is given or estimated is kept, counted or summed one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from laptrace.functions.events import feature_name
from laptrace.functions.lookups import by_age
from laptrace.operators import impute, reshape
from laptrace.operators.joins import lookup_join
from laptrace.operators.quantiles import exact_median
from laptrace.session import fresh_path
from laptrace.sources.tables import materialise
from laptrace.vocab import ADULT_AGES, PROGRESSION_DEFAULT, PROGRESSION_FACTORS, YOUTH_AGES

KEY = ["event", "course", "age"]


def split_vocabulary(marked: DataFrame) -> DataFrame:
    """event, course, age, n_train, n_test, structural, feature, in one aggregate over marks that carry their split.

    Structural features are all there; of the others, those that a youth age or a training row has.
    """
    seen = marked.groupBy(*KEY).agg(
        F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test"))
    none = F.lit(0).cast("long")
    fixed = reshape.structural_features(marked.sparkSession).select(
        *KEY, none.alias("n_train"), none.alias("n_test"), F.lit(1).alias("structural"))
    both = seen.withColumn("structural", F.lit(0)).unionByName(fixed).groupBy(*KEY).agg(
        F.sum("n_train").alias("n_train"), F.sum("n_test").alias("n_test"), F.max("structural").alias("structural"))
    kept = both.where((F.col("n_train") > 0) | F.col("age").between(*YOUTH_AGES))
    return kept.withColumn("feature", feature_name(F.col("event"), F.col("course"), F.col("age")))


def adults(marked: DataFrame) -> DataFrame:
    """split, name, event, course, best_adult and the youth ages that have a mark, at most nine."""
    age, mark = F.col("age"), F.col("time_seconds")
    return marked.where(mark.isNotNull()).groupBy("split", "name", "event", "course").agg(
        F.min(F.when(age.between(*ADULT_AGES), mark)).alias("best_adult"),
        F.collect_set(F.when(age.between(*YOUTH_AGES), age)).alias("have"),
    ).where("best_adult is not null")


def estimate(best_adult: Column, age: Column) -> Column:
    return best_adult * by_age(PROGRESSION_FACTORS, age, YOUTH_AGES[0], PROGRESSION_DEFAULT)


def implied_counts(adult: DataFrame) -> DataFrame:
    """split, event, course, age, value, n: how often each estimate occurs, without a row for each athlete and age.

    Athletes with an adult best are counted by its value; at each youth age those who have a mark there are taken off.
    """
    same = ["split", "event", "course", "best_adult"]
    ages = F.explode(F.sequence(F.lit(YOUTH_AGES[0]), F.lit(YOUTH_AGES[1]))).alias("age")
    all_ = adult.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).select(*same, ages, "n")
    have = adult.select(*same, F.explode("have").alias("age")).groupBy(*same, "age").agg((-F.count(F.lit(1))).alias("n"))
    left = all_.unionByName(have).groupBy(*same, "age").agg(F.sum("n").alias("n")).where("n > 0")
    value = estimate(F.col("best_adult"), F.col("age"))
    return left.select("split", *KEY, value.alias("value"), "n")


def millionths(value: Column) -> Column:
    """A cell in whole millionths, so that sums of cells do not depend on their order."""
    return F.round(value * F.lit(1e6)).cast("long")


@dataclass
class Imputation:
    """What the chain is made of.

    ``fills`` is one row per feature (feature, source, fill), fitted on training rows only; ``own`` and ``adult`` are the given
    values and the base of the estimates, with their split; ``counted`` has them by feature, split and value.
    """

    vocabulary: DataFrame
    fills: DataFrame
    own: DataFrame
    adult: DataFrame
    counted: DataFrame
    assigned: DataFrame


def fit(best: DataFrame, body: DataFrame, assigned: DataFrame) -> Imputation:
    """Fits the chain: ``best`` marks and ``body`` values (name, feature, value) of the athletes in ``assigned`` (name, split).

    Rows of other athletes take no part.  A feature can hold a large share of the values, so joins on it are
    measured or salted; medians are exact over counted values, estimates included.
    """
    spark = best.sparkSession
    names = assigned.select("name", "split")
    marked = materialise(lookup_join(best, names, ["name"], "inner"), fresh_path(spark, "marked"))
    vocabulary = materialise(split_vocabulary(marked), fresh_path(spark, "vocabulary"))
    adult = materialise(adults(marked), fresh_path(spark, "adults"))
    named = marked.select("split", "name", *KEY, F.col("time_seconds").alias("value"))
    times = lookup_join(named, vocabulary.select(*KEY, "feature"), KEY, "inner").select("split", "name", "feature", "value")
    measures = lookup_join(body, names, ["name"], "inner").select("split", "name", "feature", "value")
    own = materialise(times.unionByName(measures), fresh_path(spark, "own"))
    given = own.groupBy("feature", "split", "value").agg(F.count(F.lit(1)).alias("n")).withColumn("estimated", F.lit(0))
    implied = lookup_join(implied_counts(adult), vocabulary.select(*KEY, "feature"), KEY, "inner").select(
        "feature", "split", "value", "n", F.lit(1).alias("estimated"))
    counted = materialise(given.unionByName(implied), fresh_path(spark, "counted"))
    medians = exact_median(counted.where("split = 'train'"), ["feature"], "value", weight="n")
    baselines = impute.baseline(vocabulary.withColumn("n_observed", F.lit(0))).select("feature", "fill")
    fills = medians.join(baselines, "feature", "full").select(
        "feature", F.when(F.col("median").isNotNull(), "median").otherwise("baseline").alias("source"),
        F.coalesce("median", "fill").alias("fill"))
    return Imputation(vocabulary, materialise(fills, fresh_path(spark, "fills")), own, adult, counted, assigned)


def profile(made: Imputation) -> DataFrame:
    """feature, split, n_own, n_estimated, n_filled, source, fill, total: where the cells of a filled column come from.

    ``total`` is the sum of the column, each cell to the millionth.  Cells that are filled are counted as what the others leave of the rows.
    """
    rows = made.assigned.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    every = made.fills.select("*", F.explode(F.array(F.lit("train"), F.lit("test"))).alias("split")).join(
        F.broadcast(rows), "split")  # two rows
    n, value, estimated = F.col("n"), F.col("value"), F.col("estimated")
    stats = made.counted.groupBy("feature", "split").agg(
        F.sum(n * (1 - estimated)).alias("n_own"), F.sum(n * estimated).alias("n_estimated"), F.sum(n * millionths(value)).alias("known"))
    joined = every.join(stats, ["feature", "split"], "left").fillna(0, ["n_own", "n_estimated", "known"])
    left = F.col("n_rows") - F.col("n_own") - F.col("n_estimated")
    return joined.withColumn("n_filled", left).select(
        "feature", "split", "n_own", "n_estimated", "n_filled", "source", "fill",
        ((F.col("known") + F.col("n_filled") * millionths(F.col("fill"))) / 1e6).alias("total"))


def filled_rows(made: Imputation) -> DataFrame:
    """name, split, n_own, n_estimated, n_filled, total: every athlete's filled row, as counts and the sum of its cells.

    A row starts from the sum of all fills; each given or estimated cell replaces the fill of its feature.
    """
    fills = made.fills.select("feature", "fill")
    n_features, all_fills = fills.agg(F.count(F.lit(1))).scalar(), fills.agg(F.sum(millionths(F.col("fill")))).scalar()
    youth = F.sequence(F.lit(YOUTH_AGES[0]), F.lit(YOUTH_AGES[1]))
    each = made.adult.select("split", "name", "event", "course", "best_adult",
                             F.explode(F.array_except(youth, F.col("have"))).alias("age"))
    guessed = lookup_join(each, made.vocabulary.select(*KEY, "feature"), KEY, "inner").select(
        "name", "feature", estimate(F.col("best_adult"), F.col("age")).alias("value"), F.lit(1).alias("estimated"))
    cells = made.own.select("name", "feature", "value", F.lit(0).alias("estimated")).unionByName(guessed)
    sums = lookup_join(cells, fills, ["feature"], "inner").groupBy("name").agg(
        F.sum(1 - F.col("estimated")).alias("n_own"), F.sum("estimated").alias("n_estimated"),
        F.sum(millionths(F.col("value")) - millionths(F.col("fill"))).alias("more"))
    joined = made.assigned.select("name", "split").join(sums, "name", "left").fillna(
        0, ["n_own", "n_estimated", "more"])
    return joined.select("name", "split", "n_own", "n_estimated",
                         (n_features - F.col("n_own") - F.col("n_estimated")).alias("n_filled"),
                         ((all_fills + F.col("more")) / 1e6).alias("total"))


def write_profile(made: Imputation, path: str) -> DataFrame:
    """Writes the profile and returns metric, value: what its cells amount to, observed in the pass that writes it.

    missing_before, estimated and missing_after for either split, the number of features, those without a value
    in training and those filled by a baseline.
    """
    seen = Observation("imputation")
    found = {"n_features": F.count_if(F.col("split") == "train")}
    for split in ("train", "test"):
        own = F.col("split") == split
        found |= {
            f"missing_before_{split}": F.sum(F.when(own, F.col("n_estimated") + F.col("n_filled")).otherwise(0)),
            f"estimated_{split}": F.sum(F.when(own, F.col("n_estimated")).otherwise(0)),
            f"missing_after_{split}": F.sum(F.when(own & F.col("fill").isNull(), F.col("n_filled")).otherwise(0)),
        }
    train = F.col("split") == "train"
    found["features_without_values"] = F.count_if(train & (F.col("n_own") == 0))
    found["features_with_baseline"] = F.count_if(train & (F.col("source") == "baseline"))
    profile(made).observe(seen, *[F.coalesce(c, F.lit(0)).cast("double").alias(n) for n, c in found.items()]).write.parquet(path)
    values = seen.get  # one row
    return made.fills.sparkSession.createDataFrame(sorted(values.items()), "metric string, value double")
