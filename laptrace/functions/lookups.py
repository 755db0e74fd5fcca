"""Constant tables as literal maps: the lookup stays inside the projection."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F


def literal_map(table: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])


def lookup(table: dict, key: Column, default=None) -> Column:
    """Value of ``key`` in a constant table; ``default`` (or null) where the key is unknown."""
    found = F.try_element_at(literal_map(table), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def by_age(values: list, age: Column, first_age: int, default) -> Column:
    """Value for ``age`` in a list that starts at ``first_age``; ``default`` outside of it."""
    return lookup({first_age + i: v for i, v in enumerate(values)}, age.cast("int"), default)


def alternatives(words: list[str]) -> str:
    """Regex that matches any of the literal words."""
    import re

    return "(?:" + "|".join(re.escape(w).replace(r"\ ", " ") for w in words) + ")"


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, however often ``use`` mentions it.

    Needed inside and between scans of markup, where a repeated mention would repeat the scan.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def none_if_blank(col: Column) -> Column:
    """Null for the empty text; ``nullif`` alone mentions the column twice."""
    return once(col, lambda text: F.nullif(text, F.lit("")))


def hash_uniform(key: Column, salt: str) -> Column:
    """Repeatable number in [0, 1) from a key: the same on every run, retry and engine."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
