"""Stratified splits, folds and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from laptrace.operators.joins import lookup_join
from laptrace.operators.ranking import shuffled_rank
from laptrace.vocab import SEARCH_FOLDS, SEED, TEST_FRACTION


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("class_rows"))


def without_rare(df: DataFrame, label: str, at_least: int = 2) -> DataFrame:
    """Rows of classes with at least so many rows.  Classes are counted by aggregation, never gathered."""
    common = class_sizes(df, label).where(F.col("class_rows") >= at_least).select(label)
    return lookup_join(df, common, [label], "inner")


def stratified(df: DataFrame, key: str, label: str, fraction: float = TEST_FRACTION, folds: int = SEARCH_FOLDS,
               seed: int = SEED) -> DataFrame:
    """Adds ``split`` (train or test) and ``fold``; the first ``floor(n * fraction)`` of each class are the test.

    The order inside a class is that of a seeded hash of the unique key, so any run and
    any number of partitions gives the same answer.
    """
    ranked = shuffled_rank(df, [label], key, seed)
    return ranked.withColumns({
        "split": F.when(F.col("rank") <= F.floor(F.col("group_rows") * F.lit(fraction)), "test").otherwise("train"),
        "fold": F.pmod(F.col("rank"), F.lit(folds)).cast("int"),
    }).drop("rank", "group_rows")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight of every class: rows over (classes times rows of the class)."""
    sizes = class_sizes(df, label)
    rows = sizes.agg(F.sum("class_rows")).scalar()
    classes = sizes.agg(F.count(F.lit(1))).scalar()
    return sizes.withColumn("class_weight", rows / (classes * F.col("class_rows")))


def with_weights(df: DataFrame, label: str) -> DataFrame:
    return lookup_join(df, class_weights(df, label).select(label, "class_weight"), [label], "inner")
