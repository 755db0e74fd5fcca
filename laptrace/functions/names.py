"""Person names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from laptrace.functions.lookups import alternatives, once
from laptrace.vocab import COUNTRY_SUFFIXES, NON_PERSON_MARKS

# Passes over the commonest visible characters by one comparison, before any test for white space.
VISIBLE = "(?![!-~])"


def collapse_spaces(text: Column) -> Column:
    """One blank for any white space; single blanks, by far the most, are not touched."""
    return F.trim(F.regexp_replace(text, rf"(?U){VISIBLE}(?:\s{{2,}}|[^\S ])", " "))


def without_country(text: Column) -> Column:
    """Drops one trailing country name, also when it is glued to the surname."""
    return F.trim(F.regexp_replace(text, alternatives(COUNTRY_SUFFIXES) + "$", ""))


def first_two_words(text: Column) -> Column:
    return F.array_join(F.slice(F.split(text, " "), 1, 2), " ")


def is_person_name(text: Column) -> Column:
    lowered = F.lower(text)
    return (
        text.isNotNull()
        & ~lowered.rlike(alternatives(NON_PERSON_MARKS))
        & (F.length(text) >= 3)
        & ~text.rlike(r"\p{Nd}")
        & (F.size(F.split(text, " ")) >= 2)
    )


def person_name(raw: Column) -> Column:
    """First and last name, or null when the text does not name one person.

    The country goes first, so that two-word countries are recognised.
    """
    def judged(tidy: Column) -> Column:
        return once(without_country(tidy), lambda bare: F.when(
            is_person_name(tidy) & is_person_name(bare), first_two_words(bare)))

    return once(collapse_spaces(raw), judged)
