"""Stored pages: links, headers, sessions, result tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from laptrace.functions import markup as M
from laptrace.functions.names import person_name
from laptrace.operators import pages as P
from laptrace.plans import oracle as O
from laptrace.plans import views as V
from laptrace.plans.registry import query
from laptrace.vocab import PERSON_PATH

EVENT_LINKS = ["/results/2424/event/", "/event/", "/results/"]

# --- filters ----------------------------------------------------------------------


@query("page_filter__c4", f"with {O.PAGE_CTES} select page_id, url from race_pages where not regexp_matches(html, '403 Forbidden|Access Denied')")
def readable_pages(spark, sf_dir):
    return P.readable(V.stored_pages(spark, sf_dir)).select("page_id", "url")


QUALIFIES = f"""
page_text as (select *, lower({O.plain_text("html")}) as page_text from race_pages),
qualified as (
  select *, contains(page_text, 'olympic games') and (regexp_matches(page_text, '2024|jul 27|july 27|aug 4|august 4')
    or regexp_matches(html, '<a [^>]*href="[^"]*/results/2424')) as qualifies from page_text
)"""


@query("page_filter__c5", f"with {O.PAGE_CTES}, {QUALIFIES} select page_id, qualifies from qualified")
def qualifying_pages(spark, sf_dir):
    """Pages that name the games and date them or link to their results."""
    return P.with_qualification(V.stored_pages(spark, sf_dir)).select("page_id", "qualifies")


@query("first_match__f2", f"""with {O.PAGE_CTES}, {QUALIFIES}
  select athlete_id, arg_min(url, page_id) as url from qualified where qualifies group by athlete_id""")
def first_match(spark, sf_dir):
    """First qualifying page of every athlete."""
    return P.first_match(P.with_qualification(V.stored_pages(spark, sf_dir)), "athlete_id", "page_id")


# --- links ----------------------------------------------------------------------------

PAGE_LINKS = """
anchors as (
  select page_id, unnest(hits) as a, unnest(range(len(hits))) as pos
  from (select page_id, regexp_extract_all(html, '(?is)(<a\\b[^>]*\\bhref="[^"]*"[^>]*>.*?</a>)', 1) as hits from pages)
),
hrefs as (
  select page_id, min(pos) as first_pos, 'https://site.example' || replace(regexp_extract(a, 'href="([^"]*)"', 1), '&amp;', '&') as link
  from anchors where regexp_extract(a, 'href="([^"]*)"', 1) like '/%' and not regexp_matches(lower(a), '>[^<]*relay[^<]*<')
  group by page_id, link
),
ranked as (select page_id, link, row_number() over (partition by page_id order by first_pos) - 1 as pos from hrefs)"""


def page_links_of(spark, sf_dir):
    return P.links(V.table(spark, sf_dir, "pages"), "https://site.example")


@query("page_links__j1", f"with {PAGE_LINKS} select page_id, cast(pos as integer) as pos, link from ranked")
def page_links(spark, sf_dir):
    """Distinct links of every stored page in page order."""
    return P.explode_links(page_links_of(spark, sf_dir), "page_id")


@query("page_links__e6", f"with {PAGE_LINKS} select link, count(*) as n_pages from ranked group by link")
def distinct_links(spark, sf_dir):
    found = P.explode_links(page_links_of(spark, sf_dir), "page_id")
    return found.groupBy("link").agg(F.count(F.lit(1)).alias("n_pages"))


@query("top_n_links__f1", f"with {PAGE_LINKS} select page_id, cast(pos as integer) as pos, link from ranked where pos < 5")
def top_n_links(spark, sf_dir):
    """The first five links of every page."""
    return P.explode_links(page_links_of(spark, sf_dir), "page_id", at_most=5)


@query("page_links__i10", """
  select page_id, url, case when starts_with(url, 'http') then url end as absolute,
    '/p/' || page_id as path, 'https://site.example/p/' || page_id as rooted,
    regexp_extract(url, '^https?://([^/?#:]+)', 1) as host from pages""")
def absolute_urls(spark, sf_dir):
    path = F.concat(F.lit("/p/"), F.col("page_id").cast("string"))
    return V.table(spark, sf_dir, "pages").select(
        "page_id", "url", M.absolute_url(F.col("url"), "https://site.example").alias("absolute"),
        path.alias("path"), M.absolute_url(path, "https://site.example").alias("rooted"),
        F.parse_url("url", F.lit("HOST")).alias("host"))


@query("page_links__c8", f"""
  select o_orderkey as page_id, u.pos as pos, '{V.BASE_URL}' || u.link as link from (
    select o_orderkey, unnest(links) as link, cast(unnest(range(len(links))) as integer) as pos from (
      select o_orderkey, case when o_orderkey % 50 = 7 then []
        when o_orderkey % 8 = 0 then ['/results/2424/event/9']
        when o_orderkey % 5 = 4 then ['x'] else ['/results/' || o_orderkey || '/event/1', 'x'] end as links from orders)
  ) u where link <> 'x'
  union all
  select o_orderkey, case when o_orderkey % 5 = 4 then 0 else 1 end, 'https://other.example.org/event/' || o_orderkey
  from orders where o_orderkey % 50 <> 7 and o_orderkey % 8 <> 0""")
def event_links(spark, sf_dir):
    """Event links by the first pattern that hits; relays and other schemes are left out."""
    return P.explode_links(P.links(V.stored_pages(spark, sf_dir), V.BASE_URL, EVENT_LINKS), "page_id")


# --- headers and text ---------------------------------------------------------------------


@query("page_text__j3", f"select page_id, {O.plain_text('html')} as page_text from pages")
def page_text(spark, sf_dir):
    """Visible text of every stored page, whole."""
    return V.table(spark, sf_dir, "pages").select("page_id", M.plain_text(F.col("html")).alias("page_text"))


@query("page_header__j2", f"""with {O.PAGE_CTES}, both_kinds as (
    select page_id, 'race' as kind, html from race_pages union all select page_id, 'page', html from pages)
  select page_id, kind, coalesce(nullif({O.inner_text("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")}, ''),
    nullif({O.inner_text("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")}, '')) as title from both_kinds""")
def page_titles(spark, sf_dir):
    """First heading, else the document title."""
    race = V.stored_pages(spark, sf_dir).select("page_id", F.lit("race").alias("kind"), "html")
    stored = V.table(spark, sf_dir, "pages").select("page_id", F.lit("page").alias("kind"), "html")
    return race.unionByName(stored).select("page_id", "kind", M.page_title(F.col("html")).alias("title"))


@query("page_header__i2", f"""with {O.PAGE_ROWS}
  select o_orderkey as page_id, case when o_orderkey % 50 <> 7 then {O.at(V.PAGE_COURSES, "o_orderkey % 3")} end as page_course,
    case when o_orderkey % 50 = 7 then null when o_orderkey % 2 = 0
      then strftime(o_orderdate, '%b %-d') || '–28, ' || strftime(o_orderdate, '%Y') else strftime(o_orderdate, {O.DAY}) end as page_date
  from orders""")
def page_headers(spark, sf_dir):
    """Course and date that a page states for all of its results."""
    return P.headers(V.stored_pages(spark, sf_dir)).select("page_id", "page_course", "page_date")


# --- sessions and tables ------------------------------------------------------------------


@query("session_sections__j4", f"""with {O.PAGE_ROWS}
  select k as page_id, case t when 1 then 'preliminaries' when 2 then 'semifinals' else 'finals' end as session,
    cast(n + 1 as integer) as n_rows from page_tables""")
def session_sections(spark, sf_dir):
    """Sessions of every page with the size of their table, by heading or by size."""
    sized = F.transform(M.sessions(F.col("html")), lambda s: F.struct(
        s["session"].alias("session"), F.size(M.rows(s["table"])).alias("n_rows")))
    found = V.stored_pages(spark, sf_dir).select("page_id", F.explode_outer(sized).alias("s"))
    return found.where("s is not null").select("page_id", "s.*")


@query("session_choice__j5", """
  select o_orderkey as page_id, case when o_orderkey % 50 = 7 then '' when o_orderkey % 5 in (0, 3) then 'finals,semifinals'
    when o_orderkey % 5 in (1, 4) then 'finals,preliminaries' else 'finals' end as to_read from orders""")
def session_choice(spark, sf_dir):
    """Sessions to read: semifinals and finals where all three exist, else all there are."""
    read = P.sessions_to_read(P.with_sessions(V.stored_pages(spark, sf_dir)))
    return read.select("page_id", F.array_join(F.sort_array("to_read"), ",").alias("to_read"))


@query("table_rank__f4", f"""with {O.PAGE_ROWS}
  select k as page_id, cast(table_pos as integer) as pos, cast(n + 1 as integer) as n_rows,
    cast(row_number() over (partition by k order by n, table_pos) as integer) as rank_small,
    cast(row_number() over (partition by k order by n desc, table_pos desc) as integer) as rank_large from page_tables""")
def table_ranks(spark, sf_dir):
    """Tables of every page ranked by their number of rows."""
    return P.table_ranks(V.stored_pages(spark, sf_dir), "page_id")


# --- rows -----------------------------------------------------------------------------------


def lines_of(spark, sf_dir):
    return P.all_rows(V.stored_pages(spark, sf_dir), ["page_id"])


HEAD = """select k as page_id, cast(table_pos as integer) as table_pos, 0 as row_pos, 4 as n_cells, 'Rank|Name|Event|Time' as texts
  from page_tables"""


@query("race_rows__j6", f"""with {O.PAGE_ROWS}
  {HEAD} union all
  select k, cast(table_pos as integer), cast(i as integer), case when i % 2 = 0 then 6 else 4 end,
    i || '|' || person || country || '|' || event_name || '|' || time_text ||
    case when i % 2 = 0 then '|' || row_date || '|' || row_course else '' end from page_marks""")
def table_rows(spark, sf_dir):
    """Every table row with its cells."""
    return lines_of(spark, sf_dir).select(
        "page_id", "table_pos", "row_pos", F.size(M.cell_texts(F.col("row_text"))).alias("n_cells"),
        F.replace("row_text", F.lit(M.CELL_END), F.lit("|")).alias("texts"))


@query("race_rows__c10", f"""with {O.PAGE_ROWS}
  select k as page_id, cast(table_pos as integer) as table_pos, cast(i as integer) as row_pos, 6 as n_cells
  from page_marks where i % 2 = 0""")
def full_rows(spark, sf_dir):
    """Rows with at least five cells, so that the bound drops some."""
    return P.wide_enough(lines_of(spark, sf_dir), 5).select(
        "page_id", "table_pos", "row_pos", F.size(M.cell_texts(F.col("row_text"))).alias("n_cells"))


SECONDS = "case when contains(time_text, ':') then 60 + cast(split_part(time_text, ':', 2) as double) else cast(time_text as double) end"


def fields_of(spark, sf_dir):
    return P.fields(V.stored_pages(spark, sf_dir), ["page_id"])


@query("race_rows__c9", f"""with {O.PAGE_ROWS}
  select k as page_id, event_name, count(*) as n from page_marks where i <> 4 group by all""")
def essential_rows(spark, sf_dir):
    """Rows without an event or a time are dropped."""
    return P.essential(fields_of(spark, sf_dir)).groupBy("page_id", "event_name").agg(F.count(F.lit(1)).alias("n"))


@query("race_rows__f7", f"""with {O.PAGE_ROWS}
  select k as page_id, cast(table_pos as integer) as table_pos, cast(i as integer) as row_pos,
    case when i % 2 = 0 then row_course else case when i <> 4 then time_text else event_name end end as last_known from page_marks""")
def last_matching_cell(spark, sf_dir):
    """Text of the last cell that is an event, a time or a course."""
    known = M.last_cell(F.col("row_text"), f"{M.EVENT_CELL}|{M.TIME_CELL}|{M.COURSE_CELL}")
    return lines_of(spark, sf_dir).select("page_id", "table_pos", "row_pos", known.alias("last_known")).where("last_known is not null")


@query("race_rows__i17", f"""with {O.PAGE_ROWS},
  counted as (select k, i, 1 as e, cast(i <> 4 as integer) as t, cast(i % 2 = 0 as integer) as c from page_marks)
  select k as page_id, cast(sum(e) as bigint) as n_event, cast(sum(t) as bigint) as n_time,
    cast(sum(c) as bigint) as n_course, cast(sum(c) as bigint) as n_date from counted group by k""")
def cell_kinds(spark, sf_dir):
    """Cells of each kind per page."""
    cells = lines_of(spark, sf_dir).select("page_id", F.explode(M.cell_texts(F.col("row_text"))).alias("cell"))
    kinds = {"n_event": M.EVENT_CELL, "n_time": M.TIME_CELL, "n_course": M.COURSE_CELL, "n_date": M.DATE_CELL}
    return cells.groupBy("page_id").agg(
        *[F.sum(M.is_cell(F.col("cell"), kind).cast("int")).alias(name) for name, kind in kinds.items()])


@query("race_rows__d7", f"""with {O.PAGE_ROWS}
  select k as page_id, cast(table_pos as integer) as table_pos, cast(i as integer) as row_pos,
    case when i % 2 = 0 then row_course else page_course end as course,
    case when i % 2 = 0 then row_date else page_date end as race_date from page_marks where i <> 4""")
def filled_rows(spark, sf_dir):
    """Course and date of a row, taken from the page where the row has none."""
    found = P.race_records(V.stored_pages(spark, sf_dir))
    return found.select("page_id", "table_pos", "row_pos", "course", "race_date")


@query("race_rows__j8", f"""with {O.PAGE_ROWS}
  select k as page_id, '/results/' || k as url,
    'Meet ' || k || case when k % 4 = 0 and k % 7 <> 3 then ' Olympic Games' else '' end as meet_name,
    cast(table_pos as integer) as table_pos, cast(i as integer) as row_pos, person as athlete, event_name,
    {SECONDS} as time_seconds, case when i % 2 = 0 then row_course else page_course end as course,
    case when i % 2 = 0 then row_date else page_date end as race_date from page_marks where i <> 4""")
def race_records(spark, sf_dir):
    """Race records of all stored pages."""
    return P.race_records(V.stored_pages(spark, sf_dir))


@query("race_rows__j8_page_athlete", f"""with {O.PAGE_ROWS}
  select k as page_id, cast(table_pos as integer) as table_pos, cast(i as integer) as row_pos,
    case when k % 3 = 0 then {O.person("c")} else person end as athlete, cast(k % 3 = 0 as integer) as from_page, event_name,
    {SECONDS} as time_seconds from page_marks where i <> 4""")
def page_athlete_rows(spark, sf_dir):
    """Race records where a third of the pages names nobody in its rows: their rows are of the page's athlete."""
    unlinked = F.regexp_replace("html", f'<a href="{PERSON_PATH}[0-9]+">([^<]*)</a>', "$1")
    pages = V.stored_pages(spark, sf_dir).withColumns({
        "html": F.when(F.col("page_id") % 3 == 0, unlinked).otherwise(F.col("html")),
        "page_athlete": V.person(F.col("athlete_id"))})
    return P.race_records(pages, page_athlete="page_athlete").select(
        "page_id", "table_pos", "row_pos", "athlete", "from_page", "event_name", "time_seconds")


@query("clean_names__j7", f"""with {O.PAGE_ROWS}
  select k as page_id, case t when 1 then 'preliminaries' when 2 then 'semifinals' else 'finals' end as session,
    cast(i as integer) as row_pos, person as name from page_marks
  where case when k % 5 in (0, 3) then t in (2, 3) else true end""")
def page_names(spark, sf_dir):
    """One cleaned name per row of the sessions to read."""
    return P.person_names(V.stored_pages(spark, sf_dir), "page_id").select("page_id", "session", "row_pos", "name")
