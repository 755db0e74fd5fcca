"""Athlete records: column names, quarantine, duplicates, encodings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from laptrace.functions.dates import birth_date
from laptrace.functions.encoding import body_index, missing_fields, one_hot, sex_code
from laptrace.vocab import ATHLETE_ALIASES, GROUP_LABELS, REQUIRED_ATHLETE_FIELDS


def conform(df: DataFrame, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """Renames to the standard column names; of several aliases the first one present wins."""
    picked, used = {}, set()
    for target, names in (aliases or ATHLETE_ALIASES).items():
        source = next((n for n in names if n in df.columns), None)
        if source is not None:
            picked[target] = F.col(source).alias(target)
            used.add(source)
    rest = [F.col(c) for c in df.columns if c not in used and c not in picked]
    return df.select(*picked.values(), *rest)


def split_failed(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Good rows, and rows that carry an error message instead of data."""
    if error not in df.columns:
        return df, df.limit(0)
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())


def audit(df: DataFrame, required: list[str] | None = None) -> Column:
    """Column with the required fields a record lacks."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return missing_fields({name: kinds.get(name) for name in (required or REQUIRED_ATHLETE_FIELDS)})


def unique(df: DataFrame, key: str = "Name") -> DataFrame:
    """One record per key, the most complete one (then the smallest), so joins cannot multiply rows."""
    rest = [c for c in df.columns if c != key]
    gaps = sum((F.col(c).isNull().cast("int") for c in rest), F.lit(0))
    best = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(gaps.alias("gaps"), *rest)).alias("r"))
    return best.select(key, "r.*")


def prepare(df: DataFrame) -> DataFrame:
    """Raw athlete records to one clean row per name with a real birth date."""
    clean = conform(df)
    return unique(clean.withColumn("Date_of_Birth", birth_date(F.col("Date_of_Birth"))))


def encode(df: DataFrame, groups: list[str] | None = None, prefix: str = "Ethnicity_") -> DataFrame:
    """Adds the sex code, body index and group flags; other columns stay."""
    return df.withColumns({
        "Sex_encoded": sex_code(F.col("Sex")),
        **one_hot(F.col("Ethnicity"), GROUP_LABELS if groups is None else groups, prefix),
        "BMI": body_index(F.col("Weight_kg"), F.col("Height_cm")),
    })
