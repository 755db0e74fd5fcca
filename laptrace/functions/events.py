"""Event names, feature names and labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from laptrace.functions.lookups import alternatives, lookup, none_if_blank
from laptrace.vocab import (
    BASELINE_BY_DISTANCE, BASELINE_DEFAULT, BASELINE_SECONDS, LABEL_BY_EVENT, NON_INDIVIDUAL_WORDS,
    STROKE_NAMES, STROKE_TOKENS,
)

_STROKE = r"(free|back|breast|fly|(?<![a-z])im(?![a-z])|medley)"
# fixed values: the feature name grammar
_FEATURE = r"^(.+)_([A-Za-z]+)_Age(\d+)_FastestTime$"


def event_key(name: Column) -> Column:
    """``400 L Free`` and ``400m Freestyle`` both become ``400mFree``; other names stay as they are."""
    text = F.regexp_replace(F.lower(F.trim(name)), " [ls] ", " ")
    distance = F.regexp_substr(text, F.lit(r"\d+"))
    stroke = F.regexp_substr(text, F.lit(_STROKE))
    return F.coalesce(F.concat(distance, F.lit("m"), lookup(STROKE_TOKENS, stroke)), name, F.lit(""))


def programme_key(name: Column) -> Column:
    """Like ``event_key`` but relays keep their legs, so a relay never equals a solo event."""
    text = F.lower(F.trim(name))
    legs = F.regexp_extract(text, r"(\d+)\s*x\s*(\d+)", 1)
    distance = F.regexp_extract(text, r"(\d+)\s*x\s*(\d+)", 2)
    stroke = F.regexp_extract(text, _STROKE, 1)
    mixed = F.when(text.contains("mixed"), F.lit("Mixed")).otherwise(F.lit(""))
    relay = F.concat(legs, F.lit("x"), distance, F.lit("m"), mixed, lookup(STROKE_TOKENS, stroke), F.lit("Relay"))
    return (
        F.when((legs != "") & (stroke != ""), relay)
        .when(text.contains("relay"), F.lit(None).cast("string"))
        .otherwise(event_key(name))
    )


def is_individual(name: Column) -> Column:
    """No relay and no open water; empty names do not count as an event."""
    text = F.lower(F.coalesce(name, F.lit("")))
    return (text != "") & ~text.rlike(alternatives(NON_INDIVIDUAL_WORDS))


def feature_name(event: Column, course: Column, age: Column) -> Column:
    return F.concat(event, F.lit("_"), course, F.lit("_Age"), age.cast("string"), F.lit("_FastestTime"))


def feature_parts(feature: Column) -> dict[str, Column]:
    """Event, course and age of a feature name; nulls when it is no time feature."""
    return {
        "event": none_if_blank(F.regexp_extract(feature, _FEATURE, 1)),
        "course": none_if_blank(F.regexp_extract(feature, _FEATURE, 2)),
        "age": none_if_blank(F.regexp_extract(feature, _FEATURE, 3)).try_cast("int"),
    }


def standard_feature(feature: Column) -> Column:
    """Training-time spelling: no ``m`` before the long stroke names, ``Free`` and ``IM``."""
    return F.regexp_replace(feature, "m(Freestyle|Free|Backstroke|Breaststroke|Butterfly|IM)", "$1")


def indicator_name(event: Column) -> Column:
    """``50m Freestyle`` to ``Olympic_50m__Freestyle``."""
    return F.concat(F.lit("Olympic_"), F.replace(F.replace(event, F.lit(" "), F.lit("_")), F.lit("m"), F.lit("m_")))


def indicator_label(indicator: Column) -> Column:
    """``Olympic_50m__Freestyle`` back to ``50m_Freestyle``."""
    return F.replace(F.replace(indicator, F.lit("Olympic_"), F.lit("")), F.lit("__"), F.lit("_"))


def event_label(event: Column) -> Column:
    """Label of an event, by exact distance and stroke in either spelling; null when it has none."""
    distance = F.regexp_extract(event, r"^(\d+)m?([A-Za-z]+)$", 1)
    stroke = F.regexp_extract(event, r"^(\d+)m?([A-Za-z]+)$", 2)
    short = lookup({**{v: k for k, v in STROKE_NAMES.items()}, **{k: k for k in STROKE_NAMES}}, stroke)
    return lookup(LABEL_BY_EVENT, F.concat(distance, F.lit("m"), short))


def baseline_seconds(event: Column) -> Column:
    """Typical adult-level time of an event; unknown events fall back on their distance."""
    distance = F.regexp_extract(event, r"^(\d+)", 1).try_cast("int")
    return F.coalesce(
        lookup(BASELINE_SECONDS, event), lookup(BASELINE_BY_DISTANCE, distance), F.lit(BASELINE_DEFAULT)
    )
