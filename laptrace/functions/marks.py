"""Race times."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from laptrace.vocab import OPEN_THRESHOLD

# fixed values: what counts as a time
_NUMBER = r"\s*[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?\s*"
_WHOLE = r"\s*[+-]?\d+\s*"
_CLOCK = f"^(?:(?:{_WHOLE}:)?{_WHOLE}:)?{_NUMBER}$"
_ENTERED = f"^(?:{_NUMBER}:)?{_NUMBER}$"


def _sum_up(text: Column) -> Column:
    """Colon-separated parts, each worth sixty of the next; only called on text already tested."""
    return F.aggregate(F.split(text, ":"), F.lit(0.0), lambda total, part: total * 60 + part.try_cast("double"))


def seconds(text: Column) -> Column:
    """``SS.ss``, ``MM:SS.ss`` or ``H:MM:SS.ss`` as seconds; null for anything else."""
    return F.when(text.rlike(_CLOCK), _sum_up(text))


def entered_seconds(text: Column) -> Column:
    """A time typed by a user: at most minutes and seconds, either may carry a fraction."""
    return F.when(text.rlike(_ENTERED), _sum_up(text))


def is_valid_mark(value: Column) -> Column:
    """A usable time: present, a number, above zero and below the open threshold."""
    return value.isNotNull() & ~F.isnan(value) & (value > 0) & (value < OPEN_THRESHOLD)
