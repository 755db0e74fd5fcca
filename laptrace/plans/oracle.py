"""The same inputs as SQL, for checking: common table expressions to put in front of a query."""

from __future__ import annotations

from laptrace.vocab import GROUP_LABELS, NON_INDIVIDUAL_WORDS, PROGRAMME_EVENTS, STROKE_TOKENS
from laptrace.plans.views import (
    BASE_URL, DISTANCES, EVENT_WORDS, FIRST_NAMES, PAGE_COURSES, PAGE_DISTANCES, PAGE_STROKES,
)


def sql_list(values: list) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def at(values: list, index: str) -> str:
    """Element of a constant list, from zero."""
    return f"({sql_list(values)})[cast({index} as integer) + 1]"


def case(table: dict, key: str, default: str = "null") -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else f"cast({v} as double)" if isinstance(v, float) else str(v)

    arms = " ".join(f"when {lit(k)} then {lit(v)}" for k, v in table.items())
    return f"(case {key} {arms} else {default} end)"


def uniform(key: str, salt: str) -> str:
    return f"(cast('0x' || substr(md5(cast({key} as varchar) || '|{salt}'), 1, 8) as bigint) / 4294967296.0)"


DAY = "'%b %-d, %Y'"

ATHLETES = f"""
athletes_raw as (
  select s_suppkey, s_name as name,
    case when s_suppkey % 13 = 5 then strftime(d, '%Y') else strftime(d, '%Y-%m-%d') end as dob,
    case when s_suppkey % 11 <> 0 then cast(150 + s_suppkey % 50 as double) end as height_cm,
    cast(45 + s_suppkey % 60 as double) as weight_kg,
    {at(["male", "Female", "unknown"], "s_suppkey % 3")} as gender,
    case when s_suppkey % 2 = 0
      then array_to_string(list_transform(string_split(g, ' '), lambda w: upper(w[1:1]) || w[2:]), ' ') else g end as race,
    case when s_suppkey % 5 <> 0
      then ({sql_list(PROGRAMME_EVENTS)})[(1 + s_suppkey % 4):(2 + s_suppkey % 4)] else [] end as paris_2024_races
  from (select *, date '1975-01-01' + cast((s_suppkey * 37) % 3650 as integer) as d,
               {at([*GROUP_LABELS, "unknown"], "s_nationkey % 7")} as g from supplier)
),
athletes as (
  select *, case when length(dob) = 4 then make_date(cast(dob as integer), 1, 1) else cast(dob as date) end as born
  from athletes_raw
)"""

RACE_RAW = f"""
race_raw as (
  select s_name as name, l_linenumber, l_orderkey,
    case l_returnflag when 'A' then 'LCM' when 'N' then 'SCM' else 'SCY' end as course,
    {at(DISTANCES, "l_linenumber - 1")} || ' ' ||
      case l_returnflag when 'A' then 'L ' when 'N' then 'S ' else '' end ||
      {at(EVENT_WORDS, "l_partkey % 6")} as event_name,
    case l_linenumber % 3 when 0 then strftime(l_shipdate, {DAY}) when 1 then strftime(l_shipdate, '%Y-%m-%d')
      else strftime(l_shipdate, '%b %-d') || '–28, ' || strftime(l_shipdate, '%Y') end as race_date,
    cast(cast(floor(l_extendedprice / 60000) as bigint) as varchar) || ':' ||
      lpad(cast(cast(floor(l_quantity) as bigint) as varchar), 2, '0') || '.' ||
      lpad(cast(cast(floor(l_discount * 100) as bigint) as varchar), 2, '0') as time_text,
    'Meet ' || l_orderkey as meet_name,
    '{BASE_URL}/results/' || l_orderkey as meet_url
  from lineitem join supplier on l_suppkey = s_suppkey
)"""


def event_key(col: str) -> str:
    text = f"regexp_replace(lower(trim({col})), ' [ls] ', ' ', 'g')"
    stroke = f"regexp_extract({text}, '(free|back|breast|fly|medley)', 1)"
    tokens = {k: v for k, v in STROKE_TOKENS.items() if k != "im"}
    word = f"coalesce({case(tokens, stroke)}, case when regexp_matches({text}, '(^|[^a-z])im([^a-z]|$)') then 'IM' end)"
    return (f"case when regexp_extract({text}, '([0-9]+)', 1) <> '' and {word} is not null "
            f"then regexp_extract({text}, '([0-9]+)', 1) || 'm' || {word} else coalesce({col}, '') end")


def race_day(col: str) -> str:
    return (f"cast(coalesce(try_strptime({col}, '%Y-%m-%d'), "
            f"try_strptime(regexp_replace({col}, '–[0-9]+', ''), '%b %d, %Y')) as date)")


def seconds(col: str) -> str:
    return (f"(cast(split_part({col}, ':', 1) as integer) * 60 + cast(split_part({col}, ':', 2) as double))")


RACES = f"""
races as (
  select *, {event_key("event_name")} as event, {race_day("race_date")} as race_day,
    {seconds("time_text")} as time_seconds
  from race_raw
)"""

INDIVIDUAL = f"not regexp_matches(lower(event_name), '{'|'.join(NON_INDIVIDUAL_WORDS)}')"


def years(born: str, day: str) -> str:
    return (f"(case when {born} is not null and {day} is not null then greatest(0, cast(year({day}) - year({born}) - "
            f"cast(month({day}) * 100 + day({day}) < month({born}) * 100 + day({born}) as integer) as integer)) end)")


BEST = f"""
best as (
  select r.name, event, course, cast({years("born", "race_day")} as integer) as age, min(time_seconds) as time_seconds
  from races r join athletes a on a.name = r.name
  where {INDIVIDUAL} and race_day is not null and born is not null and course is not null
  group by all
)"""


def feature(event: str = "event", course: str = "course", age: str = "age") -> str:
    return f"({event} || '_' || {course} || '_Age' || {age} || '_FastestTime')"


RACE_CTES = f"{ATHLETES}, {RACE_RAW}, {RACES}"
BEST_CTES = f"{RACE_CTES}, {BEST}"


def person(key: str) -> str:
    letters = f"translate(cast({key} as varchar), '0123456789', 'abcdefghij')"
    return f"({at(FIRST_NAMES, f'{key} % 8')} || ' ' || upper({letters}[1:1]) || {letters}[2:])"


# Rows of the result tables (t: 1 preliminary, 2 semifinal, 3 final), without going through markup.
PAGE_ROWS = f"""
page_tables as (
  select o_orderkey as k, o_custkey as c, o_orderdate as d, t,
    case t when 1 then 4 + o_orderkey % 3 when 2 then 3 else 1 + o_orderkey % 2 end as n,
    row_number() over (partition by o_orderkey order by t) - 1 as table_pos
  from orders cross join (values (1), (2), (3)) v(t)
  where o_orderkey % 50 <> 7
    and case o_orderkey % 5 when 0 then true when 3 then true when 2 then t = 3 else t in (1, 3) end
),
page_rows as (
  select *, c + i as key,
    {person("(c + i)")} as person,
    case when (c + i) % 3 = 0 then 'United States' when (c + i) % 3 = 1 then ' France' else '' end as country,
    {at(PAGE_DISTANCES, "(k + i) % 5")} || ' ' || {at(PAGE_STROKES, "(k + t) % 6")} as event_name,
    20 + (c * 31 + i * 17 + t * 5) % 40 as sec,
    {at(PAGE_COURSES, "(k + i) % 3")} as row_course,
    strftime(d + to_days(cast(i as integer)), {DAY}) as row_date,
    {at(PAGE_COURSES, "k % 3")} as page_course,
    case when k % 2 = 0 then strftime(d, '%b %-d') || '–28, ' || strftime(d, '%Y') else strftime(d, {DAY}) end as page_date
  from (select *, unnest(range(1, n + 1)) as i from page_tables)
),
page_marks as (
  select *, case when i = 4 then 'DQ' when i % 3 = 0 then '1:' || sec || '.' || lpad(cast(k % 100 as varchar), 2, '0')
                 else sec || '.' || lpad(cast(k % 100 as varchar), 2, '0') end as time_text
  from page_rows
)"""

# The same pages as markup, put together from the rows.
PAGES = f"""
table_html as (
  select k, t, '<table>' || chr(10) || '<tr><th>Rank</th><th>Name</th><th>Event</th><th>Time</th></tr>' || chr(10) ||
    string_agg('<tr><td>' || i || '</td><td><a href="/swimmer/' || key || '">' || person || country || '</a></td><td>' ||
      event_name || '</td><td>' || time_text || '</td>' ||
      case when i % 2 = 0 then '<td>' || row_date || '</td><td>' || row_course || '</td>' else '' end ||
      '</tr>' || chr(10), '' order by i) || '</table>' || chr(10) as html
  from page_marks group by k, t
),
page_sections as (
  select k, string_agg(case k % 5
      when 0 then case t when 1 then '<h2>Preliminaries</h2>' when 2 then '<h2>Semifinals</h2>' else '<h2>Finals</h2>' end || chr(10)
      when 1 then case t when 1 then '<h2>Prelims</h2>' else '<h2>Finals</h2>' end || chr(10)
      when 2 then '<h2>Men Finals</h2>' || chr(10) else '' end || html, '' order by t) as html
  from table_html group by k
),
race_pages as (
  select o_orderkey as page_id, o_custkey as athlete_id, '/results/' || o_orderkey as url,
    case when o_orderkey % 50 = 7 then '<html><body><h1>403 Forbidden</h1></body></html>' else
    '<html><head><title>Meet ' || o_orderkey || '</title><style>p{{margin:0}}</style><script>var t="<b>";</script></head><body><nav>' ||
    case when o_orderkey % 5 = 4 then '' else '<a href="/results/' || o_orderkey || '/event/1">50 Free</a><a href="/results/' ||
      o_orderkey || '/event/2">4x100 Free Relay</a><a href="/results/' || o_orderkey || '/event/1">50 Free</a>' end ||
    '<a href="mailto:info@example.org">Contact</a><a href="https://other.example.org/event/' || o_orderkey || '">Partner</a>' ||
    case when o_orderkey % 8 = 0 then '<a href="/results/2424/event/9">Archive</a>' else '' end ||
    '</nav><!-- generated -->' || chr(10) ||
    case when o_orderkey % 7 = 3 then '' else '<h1>Meet ' || o_orderkey || case when o_orderkey % 4 = 0 then ' Olympic Games' else '' end || '</h1>' || chr(10) end ||
    '<p>' || case when o_orderkey % 2 = 0 then strftime(o_orderdate, '%b %-d') || '–28, ' || strftime(o_orderdate, '%Y') else strftime(o_orderdate, {DAY}) end ||
    ' &middot; ' || {at(PAGE_COURSES, "o_orderkey % 3")} || '</p>' || chr(10) || html || '</body></html>' end as html
  from orders left join page_sections on k = o_orderkey
)"""

PAGE_CTES = f"{PAGE_ROWS}, {PAGES}"


# The entities that the pages hold; the oracle has its own list.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&ndash;": "–", "&copy;": "©",
            "&middot;": "·", "&amp;": "&"}


def plain_text(html: str) -> str:
    body = f"regexp_replace({html}, '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', ' ', 'g')"
    out = f"regexp_replace({body}, '(?s)<[^>]*>', ' ', 'g')"
    for entity, char in ENTITIES.items():
        out = f"replace({out}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


def inner_text(fragment: str) -> str:
    out = f"regexp_replace({fragment}, '(?s)<[^>]*>', '', 'g')"
    for entity, char in ENTITIES.items():
        out = f"replace({out}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


NAMES_RAW = f"""
names_raw as (
  select c_custkey as key, case c_custkey % 8
    when 0 then {person("c_custkey")}
    when 1 then {person("c_custkey")} || 'United States'
    when 2 then '  ' || replace({person("c_custkey")}, ' ', ' ' || chr(9) || ' ') || ' South Africa '
    when 3 then 'Relay ' || {person("c_custkey")}
    when 4 then {at(FIRST_NAMES, "c_custkey % 8")}
    when 5 then c_name
    when 6 then {person("c_custkey")} || ' and ' || {person("(c_custkey + 1)")}
    else {person("c_custkey")} || ' Junior' || 'Japan' end as raw_name
  from customer
)"""


def tidy(col: str) -> str:
    return f"trim(regexp_replace({col}, '\\s+', ' ', 'g'))"


def bare(col: str) -> str:
    from laptrace.vocab import COUNTRY_SUFFIXES

    return f"trim(regexp_replace({col}, '({'|'.join(COUNTRY_SUFFIXES)})$', ''))"


def valid_person(col: str) -> str:
    return (f"({col} is not null and not regexp_matches(lower({col}), 'relay|team|&| and |,') and length({col}) >= 3 "
            f"and not regexp_matches({col}, '[0-9]') and len(string_split({col}, ' ')) >= 2)")


def two_words(col: str) -> str:
    return f"array_to_string((string_split({col}, ' '))[1:2], ' ')"


def case_chain(arms: list[tuple[str, str]], default: str) -> str:
    return "(case " + " ".join(f"when {c} then {v}" for c, v in arms) + f" else {default} end)"
