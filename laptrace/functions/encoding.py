"""Encoders and audits for athlete attributes."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType

from laptrace.functions.lookups import lookup
from laptrace.vocab import SEX_CODES


def body_index(weight_kg: Column, height_cm: Column) -> Column:
    """Weight over squared height in metres; null if either is missing or the height is not positive."""
    return F.when(height_cm > 0, weight_kg / F.pow(height_cm / 100, F.lit(2)))


def sex_code(text: Column) -> Column:
    return lookup(SEX_CODES, F.lower(F.trim(text)))


def label_slug(text: Column) -> Column:
    """Spelling used for scoring input: lower case, blanks as underscores."""
    return F.replace(F.lower(text), F.lit(" "), F.lit("_"))


def one_hot(text: Column, vocabulary: list[str], prefix: str) -> dict[str, Column]:
    """One 0/1 column per vocabulary entry; unknown or missing values give zeros only.

    Matches regardless of case and of blank or underscore, so stored and typed labels share one encoder.
    """
    slug = F.coalesce(label_slug(text), F.lit(""))
    return {
        prefix + re.sub(r"\s+", "_", value.title()): (slug == value.lower().replace(" ", "_")).cast("int")
        for value in vocabulary
    }


def missing_fields(fields: dict[str, DataType | None]) -> Column:
    """Names of the fields that are absent (type ``None``), null, empty text or an empty list."""
    gaps = []
    for name, kind in fields.items():
        if kind is None:
            gap = F.lit(True)
        elif isinstance(kind, StringType):
            gap = F.col(name).isNull() | (F.col(name) == "")
        elif isinstance(kind, ArrayType):
            gap = F.col(name).isNull() | (F.size(F.col(name)) == 0)
        else:
            gap = F.col(name).isNull()
        gaps.append(F.when(gap, F.lit(name)))
    return F.array_compact(F.array(*gaps))
