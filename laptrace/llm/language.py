"""Language of web pages by Bayesian fusion of evidence.

Text likelihoods over byte trigrams, the language a page declares in its markup, the suffix of its
address, and a prior of its host are multiplied.  The host's prior is smoothed towards that of its
domain, and that one towards all pages; all counts are grouped aggregates of what the texts alone say.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laptrace.llm.tables import stored
from laptrace.llm.words import LOWER, Words, mixed, slices

#: Bins that byte trigrams are hashed into.
BINS = 1 << 14
#: Languages whose likelihoods a task spreads out at once.
BLOCK = 64
#: Trigrams overlap, so each counts as this much of an independent observation.
TEMPER = 0.3
#: Pages of the next level that a prior is worth when a host or domain has few pages.
SMOOTH = 4.0
#: Trigrams a page needs for its text to count in the priors.
ENOUGH = 50


def trigrams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bin of every byte trigram and the text it is in; ASCII letters in lower case, a run of blanks as one.

    Digits and ASCII marks count as blanks, so only letters tell languages apart.
    """
    buf = LOWER[words.buf]
    buf = np.where(((buf < 97) | (buf > 122)) & (buf < 128), np.uint8(32), buf)
    gap = buf == 32
    keep = np.ones(len(buf), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    keep[words.offsets[words.offsets < len(buf)]] = True  # a run ends with its text, whatever text is before it
    at = np.flatnonzero(keep)
    owner = np.searchsorted(words.offsets, at, side="right") - 1
    b = buf[at].astype(np.uint64)
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = b[:-2] << np.uint64(16) | b[1:-1] << np.uint64(8) | b[2:]
    inside = owner[:-2] == owner[2:]
    return (mixed(code[inside]) >> np.uint64(64 - 14)).astype(np.int64), owner[:-2][inside]


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict = {}
    for batch in batches:
        for part in slices(batch):
            bins, owner = trigrams(Words(part["text"]))
            langs = part["lang"].to_pylist()
            for lang in set(langs):
                own = np.array([x == lang for x in langs], bool)
                counts, docs = held.get(lang, (np.zeros(BINS, np.int64), 0))
                held[lang] = (counts + np.bincount(bins[own[owner]], minlength=BINS), docs + int(own.sum()))
    for lang, (counts, docs) in held.items():
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (len(some) + 1), pa.string()), pa.array(np.append(some, -1), pa.int32()),
             pa.array(np.append(counts[some], docs), pa.int64())], names=["lang", "bin", "n"])


class Likelihoods:
    """Log likelihood of every bin under each language: those of bins it has, and one for all others."""

    def __init__(self, bins: list[np.ndarray], counts: list[np.ndarray]):
        self.bins, self.logs, self.rest = [b.astype(np.uint16) for b in bins], [], []
        for n in counts:
            total = n.sum() + 0.5 * BINS
            self.logs.append(np.log((n + 0.5) / total))
            self.rest.append(np.log(0.5 / total))
        self.step, self.spread = BLOCK, (-1, np.zeros((0, BINS)))

    def block(self, first: int) -> np.ndarray:
        """The rows of ``step`` languages; the last ones asked for are kept."""
        if self.spread[0] != first:
            last = min(first + self.step, len(self.bins))
            table = np.repeat(np.array(self.rest[first:last])[:, None], BINS, axis=1)
            for k in range(first, last):
                table[k - first, self.bins[k]] = self.logs[k]
            self.spread = first, table
        return self.spread[1]

    def rows(self) -> Iterator[np.ndarray]:
        for first in range(0, len(self.bins), self.step):
            yield from self.block(first)


def likelihoods(labelled: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], Likelihoods]:
    """Known languages, in order, and the log likelihood of every bin under each.

    All labelled documents and all their languages count, however few documents one has; only null
    languages are left out.
    """
    narrow = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    counted = stored(narrow.filter("lang is not null").mapInArrow(_gather, "lang string, bin int, n long")
                     .groupBy("lang", "bin").agg(F.sum("n").alias("n")), "trigrams")
    known = sorted(r[0] for r in counted.filter("bin = -1").select("lang").collect())
    found = counted.filter("bin >= 0").toArrow()  # at most BINS rows for each language
    names = found["lang"].combine_chunks().dictionary_encode()
    place = {lang: k for k, lang in enumerate(known)}
    places = np.array([place[x] for x in names.dictionary.to_pylist()], np.int64)
    rows = places[np.asarray(names.indices)] if len(places) else places
    order = np.argsort(rows, kind="stable")
    cuts = np.searchsorted(rows[order], np.arange(1, len(known)))
    bins, counts = np.asarray(found["bin"])[order], np.asarray(found["n"])[order].astype(float)
    return known, Likelihoods(np.split(bins, cuts), np.split(counts, cuts))


def visible(html: Column) -> Column:
    """A page's text: without scripts, styles, comments, tags and entities.

    What follows the last ``>`` holds no whole tag.  It is set aside first, so that every ``<`` looked
    at ends somewhere and a page of open brackets is read once.
    """
    page = shown(html)
    tail = F.substring_index(page, ">", -1)
    tags = F.substring(page, F.lit(1), F.char_length(page) - F.char_length(tail))
    return F.regexp_replace(F.concat(F.regexp_replace(tags, r"<[^>]*>", " "), tail), r"&#?\w+;", " ")


def shown(html: Column) -> Column:
    """A page without scripts, styles and comments; one that is not closed runs to the end of the page."""
    return F.regexp_replace(html, r"(?is)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)",
                            " ")


def declared_in(html: Column) -> Column:
    """The language that the first <html> tag with one declares, wherever it is; null without."""
    tags = F.concat_ws(">", F.regexp_extract_all(shown(html), F.lit(r"(?i)<html\b[^>]*"), F.lit(0)))
    return F.nullif(F.lower(F.regexp_extract(tags, r"(?i)\blang\s*=\s*[\"']?([a-z]+)", 1)), F.lit(""))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]+)", 1))


def _weigh(table: Likelihoods):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                bins, owner = trigrams(Words(part["text"]))
                n = part.num_rows
                logs = np.stack([np.bincount(owner, weights=row[bins], minlength=n) for row in table.rows()], 1)
                seen = np.bincount(owner, minlength=n)
                best = logs.argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part[c] for c in ("page_id", "host", "domain", "suffix", "declared")]
                    + [pa.array(seen, pa.int64()), pa.array(np.where(seen >= ENOUGH, best, -1), pa.int32()),
                       pa.array(list(logs), pa.list_(pa.float64()))],
                    names=["page_id", "host", "domain", "suffix", "declared", "n_trigrams", "best", "logs"])
    return run


def identify(pages: DataFrame, labelled: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
             text: str = "text", lang: str = "lang") -> DataFrame:
    """page_id, lang, confidence, text_lang, declared, host, n_trigrams for every page.

    ``labelled`` are documents with a language, from which the likelihoods are counted.  ``lang`` is
    the likeliest language given all evidence, ``text_lang`` that of the text alone (null with fewer
    than ENOUGH trigrams).  A page's own vote is left out of its host's prior.

    A null or empty page or address gives no evidence of that kind; without any, the prior over all
    pages decides.  Ties go to the first language by name.  Ids are passed on as they are, nulls and
    repeats included; without labelled documents ``lang`` is null; other columns are not looked at; an
    empty table gives an empty result.
    """
    known, table = likelihoods(labelled, text, lang)
    count = len(known)
    host = F.nullif(host_of(F.col(url)), F.lit(""))
    narrow = pages.select(
        F.col(page_id).alias("page_id"), host.alias("host"), F.col(html).cast("string").alias("html")).select(
        "page_id", "host", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1).alias("domain"),
        F.regexp_extract("host", r"([^.]+)$", 1).alias("suffix"),
        declared_in(F.col("html")).alias("declared"),
        F.coalesce(visible(F.col("html")), F.lit("")).alias("text"))
    kind = pages.schema[page_id].dataType.simpleString()
    out = f"page_id {kind}, host string, domain string, suffix string, declared string, n_trigrams long, " \
          "best int, logs array<double>"
    if not count:
        return narrow.select("page_id", F.lit(None).cast("string").alias("lang"),
                             F.lit(None).cast("double").alias("confidence"),
                             F.lit(None).cast("string").alias("text_lang"), "declared", "host",
                             F.lit(0).cast("long").alias("n_trigrams"))
    seen = stored(narrow.mapInArrow(_weigh(table), out), "evidence")

    # grouped counts of text verdicts: hosts first, all others from those; a row for each language that has some
    def listed(votes: DataFrame, *keys: str) -> DataFrame:
        """One array of votes, a place for each language, for every key."""
        each = votes.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("m"))
        return each.select(*keys, F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda k: F.coalesce(
            F.element_at("m", k), F.lit(0)).cast("double")).alias("votes"))

    def in_all(votes: DataFrame) -> list[float]:
        found = {r["best"]: float(r["n"]) for r in votes.groupBy("best").agg(F.sum("n").alias("n")).collect()}
        return [found.get(k, 0.0) for k in range(count)]

    voted = seen.filter("best >= 0")
    hosts = stored(voted.groupBy("host", "domain", "best").agg(F.count(F.lit(1)).alias("n")), "hosts")

    def smoothed(counts: Column, prior: Column) -> Column:
        return F.transform(F.arrays_zip(counts.alias("c"), prior.alias("p")), lambda z: (z["c"] + SMOOTH * z["p"]) / (
            F.aggregate(counts, F.lit(0.0), lambda a, b: a + b) + SMOOTH))

    flat = F.array(*[F.lit(1.0 / count)] * count)
    over = in_all(hosts)
    all_pages = [(v + SMOOTH / count) / (sum(over) + SMOOTH) for v in over]
    domains = listed(hosts.groupBy("domain", "best").agg(F.sum("n").alias("n")), "domain").select(
        "domain", smoothed(F.col("votes"), F.array(*map(F.lit, all_pages))).alias("p"))
    priors = stored(listed(hosts, "host", "domain").join(domains, "domain").select(
        "host", F.col("votes"), F.col("p").alias("near")), "priors")

    # how often each language is declared, and each suffix used, under the language of the text
    def conditional(name: str) -> DataFrame:
        counts = stored(voted.filter(F.col(name).isNotNull()).groupBy(name, "best").agg(
            F.count(F.lit(1)).alias("n")), f"{name}_counts")
        total = F.array(*map(F.lit, in_all(counts)))
        return listed(counts, name).select(name, F.transform("votes", lambda x, k: (x + 0.5) / (
            F.element_at(total, (k + 1).cast("int")) + 0.5 * F.lit(count))).alias(f"{name}_like"))

    one = F.array(*[F.lit(1.0)] * count)
    joined = seen.join(conditional("declared"), "declared", "left").join(conditional("suffix"), "suffix", "left")
    joined = joined.join(priors, "host", "left")
    others = F.transform("votes", lambda v, k: v - F.when(F.col("best") == k, 1.0).otherwise(0.0))
    prior = F.when(F.col("votes").isNull(), F.array(*map(F.lit, all_pages))).otherwise(
        smoothed(others, F.coalesce(F.col("near"), flat)))
    score = F.transform(
        F.arrays_zip(F.col("logs").alias("t"), F.coalesce(F.col("declared_like"), one).alias("d"),
                     F.coalesce(F.col("suffix_like"), one).alias("s"), prior.alias("p")),
        lambda z: TEMPER * z["t"] + F.log(z["d"]) + F.log(z["s"]) + F.log(z["p"]))
    scored = joined.select("page_id", "declared", "host", "n_trigrams", "best", score.alias("score"))
    top = F.array_max("score")
    weight = F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    names = F.array(*map(F.lit, known))
    return scored.select(
        "page_id", F.element_at(names, F.array_position("score", top).cast("int")).alias("lang"),
        (1 / weight).alias("confidence"),
        F.when(F.col("best") >= 0, F.element_at(names, F.col("best") + 1)).alias("text_lang"),
        "declared", "host", "n_trigrams")
