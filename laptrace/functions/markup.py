"""Reading stored HTML with native regular expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

from laptrace.functions.dates import TEXT_DATE
from laptrace.functions.lookups import alternatives, lookup, none_if_blank, once
from laptrace.functions.names import VISIBLE, collapse_spaces
from laptrace.vocab import (
    BLOCK_PHRASES, CELL_COURSES, CELL_STROKE_WORDS, GAMES_DATE_PHRASES, GAMES_PHRASE, GAMES_RESULT_PATH,
    PERSON_PATH, SESSION_SHORT, SESSIONS,
)

# Named characters of HTML, from the standard library's table.
NAMED = {name: chr(code) for name, code in sorted(name2codepoint.items())}
# Text that runs to the next of the given tags; what is no ``<`` is passed over without a test.
UNTIL = r"[^<]*+(?:<(?!{})[^<]*+)*+"
# The inside of a tag, its end included; quoted values may hold a ``>``.
_INSIDE = r"(?:(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
TAG = f"<{_INSIDE}"
# Comments, scripts and styles, one that is not closed running to the end of the page, and tags.
HIDDEN = r"<(?:!--.*?(?:-->|\z)|" + "".join(
    rf"{tag}\b{UNTIL.format(rf'/{tag}\s*>')}(?:</{tag}\s*>)?+|" for tag in ("script", "style")) + f"{_INSIDE})"
TABLE = rf"(?i)<table\b{UNTIL.format(r'table\b|/table\s*>')}</table\s*>"
# A row whose tag is not closed before the next row opens is empty.
ROW = rf"(?i)<tr\b(?:[^<>]*+(?:<(?!tr\b)[^<>]*+)*+>({UNTIL.format(r'tr\b|/tr\s*>|/table\s*>')}))?+"


def _character(entity: Column) -> Column:
    """What an entity's inside, ``amp`` or ``#8211`` or ``#x2013``, stands for; null if nothing."""
    digits = F.when(entity.rlike("^#[xX][0-9a-fA-F]{1,6}$"), F.conv(F.substring(entity, 3, 6), 16, 10)).when(
        entity.rlike("^#[0-9]{1,7}$"), F.substring(entity, 2, 7))
    code = digits.cast("int")
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    numeric = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    return F.coalesce(numeric, F.element_at(F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair]), entity))


def unescape(text: Column) -> Column:
    """Entities, named and numbered, as characters; unknown ones stay.  One pass, so ``&amp;lt;`` is ``&lt;``."""
    return once(text, _unescaped)


def _unescaped(text: Column) -> Column:
    def piece(p: Column, i: Column) -> Column:
        entity = F.regexp_extract(p, r"^(#?\w{1,10});", 1)
        char = _character(entity)
        kept = F.concat(F.lit("&"), p)
        return F.when(i == 0, p).otherwise(F.when((entity != "") & char.isNotNull(), F.concat(
            F.when(char == "\u00a0", " ").otherwise(char), F.substr(p, F.length(entity) + 2))).otherwise(kept))

    return F.when(text.contains("&"), F.array_join(F.transform(F.split(text, "&"), piece), "")).otherwise(text)


def plain_text(html: Column) -> Column:
    """Visible text: no scripts, styles, comments or tags, white space collapsed.

    One pattern removes all kinds in one pass; what is not closed ends with the page, so no part is
    searched twice.
    """
    return collapse_spaces(unescape(F.regexp_replace(html, f"(?is){HIDDEN}", " ")))


def inner_text(fragment: Column) -> Column:
    """Text of one element: tags vanish without leaving a blank, as a glued name shows."""
    return collapse_spaces(unescape(F.regexp_replace(fragment, f"(?s){TAG}", "")))


def element_text(html: Column, tag: str) -> Column:
    """Text of the first element of a kind, null if there is none."""
    found = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1)
    return none_if_blank(inner_text(found))


def page_title(html: Column) -> Column:
    return F.coalesce(element_text(html, "h1"), element_text(html, "title"))


HREF = r"""(?is)^<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def anchors(html: Column) -> Column:
    """All closed links of a page in order, as structs of href and text; href with either quote or none.

    The page is cut where links open, so no search runs past the next one.
    """
    opened = F.filter(F.split(html, r"(?i)(?=<a\b)"), lambda a: a.rlike(HREF) & a.rlike(r"(?i)</a\s*>"))
    return F.transform(
        opened,
        lambda a: F.struct(
            unescape(F.concat(*[F.regexp_extract(a, HREF, g) for g in (1, 2, 3)])).alias("href"),
            inner_text(F.regexp_extract(a, r"(?is)^(.*?)</a\s*>", 1)).alias("text"),
        ),
    )


def absolute_url(href: Column, base: Column | str) -> Column:
    """Rooted paths get the base, full addresses stay, anything else is null."""
    root = F.lit(base) if isinstance(base, str) else base
    return F.when(href.startswith("/"), F.concat(root, href)).when(href.startswith("http"), href)


def first_hits(links: Column, patterns: list[str]) -> Column:
    """Links matching the first pattern that matches any link at all."""
    def hits(pattern: str) -> Column:
        return F.filter(links, lambda a: a["href"].contains(pattern))

    def has(pattern: str):
        return lambda a: a["href"].contains(pattern)

    out = F.filter(links, lambda a: F.lit(False))
    for pattern in reversed(patterns):
        out = F.when(F.exists(links, has(pattern)), hits(pattern)).otherwise(out)
    return out


def is_blocked(html: Column, phrases: list[str] | None = None) -> Column:
    return html.rlike(alternatives(phrases or BLOCK_PHRASES))


def qualifies(html: Column, phrase: str = GAMES_PHRASE, dates: list[str] | None = None,
              path: str = GAMES_RESULT_PATH) -> Column:
    """The page's text names the games, and dates them or links to their results."""
    linked = F.exists(anchors(html), lambda a: a["href"].contains(path))
    return once(
        F.lower(plain_text(html)),
        lambda text: text.contains(phrase) & (text.rlike(alternatives(dates or GAMES_DATE_PHRASES)) | linked))


def course_token(text: Column) -> Column:
    return F.upper(none_if_blank(F.regexp_extract(text, r"(?i)(?=[LS])\b(LCM|SCM|SCY)\b", 1)))


# --- sessions and tables --------------------------------------------------------
def session_of(heading: Column) -> Column:
    """Session a heading announces: at most three words, the session's own name last."""
    def named(text: Column) -> Column:
        short = (F.length(text) < 50) & (F.size(F.split(text, " ")) <= 3)
        last_word = F.regexp_extract(text, "([a-z]+)$", 1)
        return F.coalesce(
            lookup(SESSION_SHORT, text),
            F.when(short, once(last_word, lambda word: F.when(word.isin(SESSIONS), word))),
        )

    return once(F.lower(heading), named)


def headed_blocks(html: Column) -> Column:
    """Headings h1 to h4 in page order, each with its session and the first table before the next heading."""
    pieces = F.split(without_comments(html), r"(?i)(?=<h[1-4]\b)")
    blocks = F.filter(pieces, lambda b: b.rlike(r"(?i)^<h[1-4]\b"))
    return F.transform(
        blocks,
        lambda b, i: F.struct(
            i.alias("pos"),
            session_of(inner_text(F.regexp_extract(b, r"(?is)<h[1-4]\b[^>]*>(.*?)</h[1-4]>", 1))).alias("session"),
            F.try_element_at(tables(b), F.lit(1)).alias("table"),
        ),
    )


def without_comments(html: Column) -> Column:
    return F.when(html.contains("<!--"), F.regexp_replace(html, r"(?s)<!--.*?(?:-->|\z)", "")).otherwise(html)


def tables(html: Column) -> Column:
    """Closed tables in page order, comments left out; of nested tables the innermost.

    One search finds them all, and none of its steps runs past where the next table opens.
    """
    return F.regexp_extract_all(without_comments(html), F.lit(TABLE), F.lit(0))


def rows(table: Column) -> Column:
    """Contents of the rows of a table; a row that is not closed ends where the next one opens."""
    return F.regexp_extract_all(table, F.lit(ROW), F.lit(1))


def by_size(page_tables: Column) -> Column:
    """Tables of a page from fewest to most rows, page order among equals."""
    return F.array_sort(
        F.transform(
            page_tables,
            lambda t, i: F.struct(F.size(rows(t)).alias("n_rows"), i.alias("pos"), t.alias("table")),
        )
    )


def sized_sessions(ranked: Column) -> Column:
    """Sessions guessed from table sizes: smallest final, second semifinal, largest preliminary."""

    def entry(session: str, at: int) -> Column:
        return F.struct(F.lit(session).alias("session"), F.try_element_at(ranked, F.lit(at))["table"].alias("table"))

    n = F.size(ranked)
    return (
        F.when(n >= 3, F.array(entry("finals", 1), entry("semifinals", 2), entry("preliminaries", -1)))
        .when(n == 2, F.array(entry("finals", 1), entry("preliminaries", 2)))
    )


def headed_sessions(blocks: Column) -> Column:
    """Sessions named by headings that own a table; the last heading of a session counts."""

    def last_of_each(own: Column) -> Column:
        def of(session: str) -> Column:
            return F.try_element_at(F.filter(own, lambda b: b["session"] == session), F.lit(-1))

        return F.array_compact(F.array(*[of(session) for session in SESSIONS]))

    own = F.filter(blocks, lambda b: b["session"].isNotNull() & b["table"].isNotNull())
    return F.transform(once(own, last_of_each), lambda b: F.struct(b["session"].alias("session"), b["table"].alias("table")))


def sessions(html: Column) -> Column:
    """Array of (session, table): from headings, else from table sizes; empty if neither tells."""
    empty = F.array().cast("array<struct<session:string,table:string>>")
    guessed = once(by_size(tables(html)), sized_sessions)
    return once(
        headed_sessions(headed_blocks(html)),
        lambda named: F.when(F.size(named) > 0, named).otherwise(F.coalesce(guessed, empty)))


def sessions_to_read(available: Column) -> Column:
    """Semifinals and finals if all three exist, else whatever is there."""
    full = F.size(F.array_intersect(available, F.array(*[F.lit(s) for s in SESSIONS]))) == len(SESSIONS)
    return F.when(full, F.array(F.lit("semifinals"), F.lit("finals"))).otherwise(available)


# --- rows and cells ----------------------------------------------------------------
# A row becomes one text with a separator between its cells.  Finding the last cell of a
# kind is then a single regular expression, with no array to walk.

CELL_END = "\x1f"
# an event names a distance before its stroke, so that no person's name is one
EVENT_CELL = rf"(?i:[^{CELL_END}\d]*+\d[^{CELL_END}]*?(?:{alternatives(CELL_STROKE_WORDS)}|(?<![a-z])im(?![a-z]))[^{CELL_END}]*+)"
TIME_CELL = r"\d{1,2}:\d{2}\.\d{2}|\d{1,3}\.\d{2}|\d{1,2}:\d{2}:\d{2}(?:\.\d{1,2})?"
COURSE_CELL = f"(?i:{alternatives(CELL_COURSES)})"
# either form has four digits in a row, which cells of other kinds seldom do
DATE_CELL = rf"(?=[^{CELL_END}]*\d{{4}})(?:[^{CELL_END}]*?(?:{TEXT_DATE})[^{CELL_END}]*+|\d{{4}}-\d{{2}}-\d{{2}})"


def lines(html: Column) -> Column:
    """Rows of all tables of a page, as structs of table, row and markup."""
    def of_table(table: Column, t: Column) -> Column:
        return F.transform(rows(table), lambda r, i: F.struct(
            t.alias("table_pos"), i.alias("row_pos"), r.alias("row")))

    return F.flatten(F.transform(tables(html), of_table))


def row_text(row: Column) -> Column:
    """Texts of the cells of a row, a separator between them; tags vanish without leaving a blank."""
    cut = F.regexp_replace(row, r"(?i)<t[dh]\b[^>]*>", CELL_END)
    text = unescape(F.regexp_replace(cut, f"(?s){TAG}", ""))
    tidy = F.regexp_replace(text, rf"(?U){VISIBLE}(?:\s{{2,}}|[^\S \x1f])", " ")
    for padded in (f" {CELL_END}", f"{CELL_END} "):
        tidy = F.replace(tidy, F.lit(padded), F.lit(CELL_END))
    return F.trim(F.regexp_replace(tidy, f"^[^{CELL_END}]*{CELL_END}", ""))


def cell_texts(text: Column) -> Column:
    return F.split(text, CELL_END)


def is_cell(text: Column, kind: str) -> Column:
    """Is the text of one cell of the given kind?"""
    return text.rlike(f"^(?:{kind})$")


def last_cell(text: Column, kind: str) -> Column:
    """Last cell of a kind in the text of a row, null if there is none."""
    bounded = F.concat(F.lit(CELL_END), text, F.lit(CELL_END))
    return none_if_blank(F.regexp_extract(bounded, f"(?s)^.*{CELL_END}({kind}){CELL_END}", 1))


def person_link_text(row: Column, path: str = PERSON_PATH) -> Column:
    """Text of the first link to a person outside the rank cell, null if there is none."""
    person = rf"""(?is)^.*?</t[dh]\s*>.*?<a\b[^>]*\bhref\s*=\s*["']?[^"'>]*{path}[^>]*>(.*?)</a\s*>"""
    return none_if_blank(inner_text(F.regexp_extract(row, person, 1)))


def row_fields(text: Column) -> dict[str, Column]:
    """Event, time, course and date of a result row as text, the last matching cell of each kind winning."""
    return {
        "event_name": last_cell(text, EVENT_CELL),
        "time_text": last_cell(text, TIME_CELL),
        "course": F.upper(last_cell(text, COURSE_CELL)),
        "race_date": last_cell(text, DATE_CELL),
    }
