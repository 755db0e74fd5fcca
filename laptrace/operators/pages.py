"""Extraction from stored pages.  One page is one row; nothing here shuffles except distinct names.

A page is taken apart inside its row, into arrays; the arrays are exploded once, at the
end.  ``explode_outer`` with a null test is used on purpose: for a plain explode the
optimizer adds a filter on the array below it, which would scan every page a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from laptrace.functions import markup as M
from laptrace.functions.dates import first_date_text
from laptrace.functions.lookups import once
from laptrace.functions.marks import seconds
from laptrace.functions.names import person_name


def links(pages: DataFrame, base: str, patterns: list[str] | None = None, skip_word: str = "relay") -> DataFrame:
    """Absolute, distinct links of every page in page order (column ``links``).

    With patterns, only links matching the first pattern that occurs on the page.
    Links whose text has ``skip_word`` and hrefs that are neither rooted nor http are left out.
    """
    def of(found) -> Column:
        chosen = M.first_hits(found, patterns) if patterns else found
        kept = F.filter(chosen, lambda a: ~F.lower(a["text"]).contains(skip_word))
        return F.array_distinct(F.array_compact(F.transform(kept, lambda a: M.absolute_url(a["href"], base))))

    return pages.withColumn("links", once(M.anchors(F.col("html")), of))


def explode_links(linked: DataFrame, key: str, at_most: int | None = None) -> DataFrame:
    """One row per link; ``at_most`` keeps the first n of each page inside the row, without a window."""
    array = F.col("links") if at_most is None else F.slice("links", 1, at_most)
    return linked.select(key, F.posexplode_outer(array).alias("pos", "link")).where("pos is not null")


def headers(pages: DataFrame) -> DataFrame:
    """Adds title, visible text and the page's first course token and date."""
    facts = once(M.plain_text(F.col("html")), lambda t: F.struct(
        t.alias("page_text"), M.course_token(t).alias("page_course"), first_date_text(t).alias("page_date")))
    return pages.withColumns({"title": M.page_title(F.col("html")), "__facts": facts}).select(
        "*", "__facts.*").drop("__facts")


def readable(pages: DataFrame, phrases: list[str] | None = None) -> DataFrame:
    """Drops pages that show a block notice instead of content."""
    return pages.where(~M.is_blocked(F.col("html"), phrases))


def with_qualification(pages: DataFrame, **rule) -> DataFrame:
    return pages.withColumn("qualifies", M.qualifies(F.col("html"), **rule))


def with_sessions(pages: DataFrame) -> DataFrame:
    """Adds ``sessions``, an array of (session, table), from headings or else from table sizes."""
    return pages.withColumn("sessions", M.sessions(F.col("html")))


def sessions_to_read(with_tables: DataFrame) -> DataFrame:
    """Adds ``to_read``: the sessions of the page that the choice rule picks."""
    return with_tables.withColumn(
        "to_read", M.sessions_to_read(F.transform("sessions", lambda s: s["session"])))


def table_ranks(pages: DataFrame, key: str) -> DataFrame:
    """Tables of a page with their size, and rank from small to large and from large to small."""
    ranked = once(
        M.by_size(M.tables(F.col("html"))),
        lambda s: F.transform(s, lambda t, i: F.struct(
            t["pos"].alias("pos"), t["n_rows"].alias("n_rows"),
            (i + 1).alias("rank_small"), (F.size(s) - i).alias("rank_large"))))
    return pages.select(key, F.explode_outer(ranked).alias("t")).where("t is not null").select(key, "t.*")


def session_rows(pages: DataFrame, key: str) -> DataFrame:
    """One row per table row of the sessions to read."""
    def picked(found: Column) -> Column:
        return once(
            M.sessions_to_read(F.transform(found, lambda s: s["session"])),
            lambda names: F.filter(found, lambda s: F.array_contains(names, s["session"])))

    def cut(s: Column) -> Column:
        return F.transform(M.rows(s["table"]), lambda r, i: F.struct(
            s["session"].alias("session"), i.alias("row_pos"), r.alias("row")))

    lines = F.flatten(F.transform(once(M.sessions(F.col("html")), picked), cut))
    return pages.select(key, F.explode_outer(lines).alias("l")).where("l is not null").select(key, "l.*")


def person_names(pages: DataFrame, key: str) -> DataFrame:
    """One valid person name per row of the sessions to read."""
    found = session_rows(pages, key)
    raw = keep_once(found, "raw_name", M.person_link_text(F.col("row")))
    return keep_once(raw.where("raw_name is not null"), "name", person_name(F.col("raw_name"))).where("name is not null")


def keep_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a costly column in a way that filters above it cannot make the optimizer compute it again."""
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def all_rows(pages: DataFrame, carry: list[str]) -> DataFrame:
    """One row per table row of a page: its markup, its text, and the carried page columns."""
    found = F.explode_outer(M.lines(F.col("html"))).alias("l")
    lines = pages.select(*carry, found).where("l is not null").select(*carry, "l.*")
    return keep_once(lines, "row_text", M.row_text(F.col("row")))


def wide_enough(lines: DataFrame, at_least: int = 3) -> DataFrame:
    return lines.where(F.size(M.cell_texts(F.col("row_text"))) >= at_least)


def fill_from_page(course: Column, date: Column) -> dict[str, Column]:
    return {"course": F.coalesce(course, F.col("page_course")), "race_date": F.coalesce(date, F.col("page_date"))}


def essential(records: DataFrame) -> DataFrame:
    """Records that have an event and a time."""
    return records.where("event_name is not null and event_name <> '' and time_seconds is not null and time_seconds <> 0")


def fields(pages: DataFrame, carry: list[str], at_least: int = 3) -> DataFrame:
    """One row per table row with enough cells: its event, time, course and date, and its markup."""
    kept = keep_once(
        wide_enough(all_rows(pages, carry), at_least), "f",
        F.struct(*[c.alias(n) for n, c in M.row_fields(F.col("row_text")).items()]))
    return keep_once(kept.select("*", "f.*").drop("f"), "time_seconds", seconds(F.col("time_text")))


def race_records(pages: DataFrame, page_key: str = "page_id", url: str = "url", page_athlete: str | None = None) -> DataFrame:
    """Race records of all result tables of all readable pages.

    ``page_athlete`` names a column with the person a page is about: rows that link to nobody with a valid name are
    theirs, and ``from_page`` says so.  Without it such rows have no athlete.
    """
    page = headers(readable(pages)).withColumn("meet_name", F.coalesce(F.col("title"), F.lit("Unknown Meet")))
    parent = [page_athlete] if page_athlete else []
    found = essential(fields(page, [page_key, url, "meet_name", "page_course", "page_date", *parent]))
    linked = keep_once(found, "athlete", person_name(M.person_link_text(F.col("row"))))
    filled = linked.withColumns(fill_from_page(F.col("course"), F.col("race_date")))
    if page_athlete:
        filled = filled.withColumn("from_page", F.col("athlete").isNull().cast("int")).withColumn(
            "athlete", F.coalesce("athlete", F.col(page_athlete)))
    return filled.select(page_key, url, "meet_name", "table_pos", "row_pos", "athlete", "event_name", "time_seconds",
                         "course", "race_date", *["from_page"] * bool(page_athlete))


def first_match(candidates: DataFrame, key: str, order: str, url: str = "url", flag: str = "qualifies") -> DataFrame:
    """First qualifying page per key; combined before the shuffle."""
    return candidates.where(F.col(flag)).groupBy(key).agg(F.min_by(url, order).alias(url))
