"""JSON objects written as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def without_fences(text: Column) -> Column:
    """Drops a markdown code fence around the text."""
    return F.trim(F.regexp_replace(F.trim(text), r"^```(?:json)?|```$", ""))


def json_object(text: Column, schema: str) -> Column:
    """The object in the text, null where it does not parse."""
    return F.from_json(without_fences(text), schema, {"mode": "PERMISSIVE"})
