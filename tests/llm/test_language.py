import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from laptrace.llm import language
from laptrace.llm.words import mixed

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_accuracy_without_markup(spark, labelled):
    """The declared language is hidden, so text and hosts must find it."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    declared = F.regexp_extract("html", 'lang="([a-z]+)"', 1)
    bare = pages.withColumn("truth", declared).withColumn("html", F.regexp_replace("html", 'lang="[a-z]+"', ""))
    found = language.identify(bare, labelled).join(bare.select("page_id", "truth"), "page_id")
    assert found.filter("declared is not null").count() == 0
    assert found.filter("lang = truth").count() >= 0.97 * pages.count()


def test_evidence_decides_where_text_is_missing(spark, labelled):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    rows = [(10 ** 6, "https://unknown.example.org/", '<html lang="fr"></html>'), (10 ** 6 + 1, None, None),
            (10 ** 6 + 2, "", ""), (None, "no address", "<p>x"), (10 ** 6, "https://unknown.example.org/", '<html lang="fr">'),
            (10 ** 6 + 3, "//u@h:80/x", "<script>" + "le la les " * 9 + "</script ><!-- der die das -->")]
    odd = spark.createDataFrame(rows, pages.schema)
    extra = {c: F.lit("clash") for c in ("host", "domain", "lang", "text", "best", "votes", "logs", "score")}
    found = language.identify(pages.unionAll(odd).withColumns(extra), labelled)
    assert found.count() == pages.count() + len(rows)
    by_id = {r.page_id: r for r in found.filter("page_id >= 1000000 or page_id is null").collect()}
    assert by_id[10 ** 6].lang == "fr" and by_id[10 ** 6].text_lang is None and by_id[10 ** 6].declared == "fr"
    assert by_id[10 ** 6 + 1].lang == "en" and by_id[10 ** 6 + 1].host is None  # most pages are English
    assert by_id[10 ** 6 + 3].n_trigrams == 0 and by_id[10 ** 6 + 3].host == "h"


def test_host_prior_helps_short_pages(spark, labelled):
    german = labelled.filter("lang = 'de'").limit(30).select(
        F.col("doc_id").alias("page_id"), F.lit("https://a.host.example.net/x").alias("url"), F.col("text").alias("html"))
    english = labelled.filter("lang = 'en'").limit(60).select(
        "doc_id", F.concat(F.lit("https://other"), "doc_id", F.lit(".example.com/")), "text")
    short = spark.createDataFrame([(-1, "https://a.host.example.net/y", "ok")], german.schema)
    found = language.identify(german.unionAll(english).unionAll(short), labelled).filter("page_id = -1").first()
    assert found.lang == "de" and found.text_lang is None


def test_empty(spark, labelled):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert language.identify(none, labelled).count() == 0
    one = spark.createDataFrame([(1, "https://a.b/", "<p>the")], none.schema)
    assert language.identify(one, labelled.limit(0)).first().lang is None


def test_rare_language_is_known(spark, labelled):
    """Three Danish documents among thousands are fewer than a thousandth."""
    text = "det er ikke så let at være gæst på øen når året går på hæld og håbet svinder " * 8
    rare = spark.createDataFrame([(f"{k} {text}", "da") for k in range(3)], "text string, lang string")
    many = labelled.select("text", "lang").crossJoin(spark.range(4)).drop("id").unionAll(rare)
    pages = spark.createDataFrame([(1, "https://x.dk/", f'<html lang="da"><p>{text}')],
                                  "page_id long, url string, html string")
    found = language.identify(pages, many).first()
    assert (found.lang, found.text_lang, found.declared) == ("da", "da", "da")


def test_languages_in_blocks(spark, labelled, monkeypatch):
    pages = spark.read.parquet(f"{SF}/pages.parquet").limit(50)
    before = sorted(map(repr, language.identify(pages, labelled).collect()))
    whole = list(language.likelihoods(labelled)[1].rows())
    monkeypatch.setattr(language, "BLOCK", 3)
    table = language.likelihoods(labelled)[1]
    assert table.step == 3 and [len(table.block(k)) for k in (0, 3)] == [3, 1]
    assert (language.np.array(list(table.rows())) == language.np.array(whole)).all()
    assert sorted(map(repr, language.identify(pages, labelled).collect())) == before
    assert abs(float(sum(map(sum, language.np.exp(whole)))) - 4) < 1e-6


def letters_of(text):
    """Bins of a text's trigrams, one by one."""
    plain = re.sub(rb"[\x00-\x60\x7b-\x7f]+", b" ", (text or "").encode().lower())
    codes = [int.from_bytes(plain[i:i + 3], "big") for i in range(len(plain) - 2)]
    return [int(b) for b in mixed(np.array(codes, np.uint64)) >> np.uint64(50)] if codes else []


def brute(pages, labelled):
    """Bayes' rule page by page, in plain Python."""
    known = sorted({lang for _, lang in labelled if lang is not None})
    likely = []
    for lang in known:
        n = Counter(b for text, own in labelled if own == lang for b in letters_of(text))
        total = sum(n.values()) + 0.5 * language.BINS
        likely.append(lambda b, n=n, total=total: math.log((n[b] + 0.5) / total))
    k, facts = len(known), []
    for page, url, html in pages:
        host = re.match(r"https?://([^/]+)", url or "")
        host = host and host[1].lower()
        text = re.sub(r"<[^>]*>", " ", html or "")
        bins = letters_of(text)
        logs = [sum(map(like, bins)) for like in likely]
        best = logs.index(max(logs)) if len(bins) >= language.ENOUGH else -1
        declared = re.search(r'<html lang="([a-z]+)"', html or "")
        parts = host.split(".") if host else []
        facts.append((page, host, ".".join(parts[-2:]) if len(parts) > 1 else "", parts[-1] if parts else None,
                      declared and declared[1], len(bins), best, logs))
    voted = [f for f in facts if f[6] >= 0]

    def smooth(counts, prior):
        return [(c + language.SMOOTH * p) / (sum(counts) + language.SMOOTH) for c, p in zip(counts, prior)]

    def votes(some):
        return [sum(f[6] == j for f in some) for j in range(k)]

    def given(place, value):
        own = [f for f in voted if f[place] == value and value is not None]
        total = votes([f for f in voted if f[place] is not None])
        return [(v + 0.5) / (t + 0.5 * k) for v, t in zip(votes(own), total)] if own else [1.0] * k

    everywhere, out = smooth(votes(voted), [1 / k] * k), []
    for page, host, domain, suffix, declared, n, best, logs in facts:
        mine = [f for f in voted if f[1] == host and host is not None]
        prior = everywhere
        if mine:
            near = smooth(votes([f for f in voted if f[1] is not None and f[2] == domain]), everywhere)
            prior = smooth([v - (j == best) for j, v in enumerate(votes(mine))], near)
        score = [language.TEMPER * t + math.log(d) + math.log(s) + math.log(p)
                 for t, d, s, p in zip(logs, given(4, declared), given(3, suffix), prior)]
        top = max(score)
        out.append((page, known[score.index(top)], round(1 / sum(math.exp(x - top) for x in score), 6),
                    known[best] if best >= 0 else None, declared, host, n))
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_against_brute_force(spark, parts):
    """Every column of every page, however the pages are dealt to tasks."""
    rng = random.Random(5)
    words = {lang: ["".join(rng.choices(letters, k=rng.randrange(2, 8))) for _ in range(40)]
             for lang, letters in (("aa", "abcdefgh"), ("bb", "efghijklm"), ("cc", "ghabmnøæ"))}
    labelled = [(" ".join(rng.choices(words[lang], k=40)), lang) for lang in words for _ in range(4)]
    labelled += [(None, "aa"), ("", "dd"), ("x y z", None)]
    pages = [(1000, None, None), (1001, "", ""), (1002, "http://a.one.org/", None), (1000, "http://new.org/", "ab")]
    for i in range(80):
        lang = rng.choice(list(words))
        said = rng.choice(["", f'<html lang="{lang}">', '<html lang="bb">', '<html lang="zz">'])
        text = " ".join(rng.choices(words[lang] + words["bb"][:9], k=rng.choice([0, 1, 4, 30])))
        host = rng.choice([f"{lang}.one.org", "a.one.org", "b.two.net", "localhost", f"x{i}.{lang}"])
        pages.append((i, f"http://{host}/p", f"{said} <p>{text}</p>" + rng.choice(["", " ", "\n"])))
    docs = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(parts)
    known = spark.createDataFrame(labelled, "text string, lang string").repartition(parts)
    found = [(r.page_id, r.lang, round(r.confidence, 6), r.text_lang, r.declared, r.host, r.n_trigrams)
             for r in language.identify(docs, known).collect()]
    assert sorted(found, key=repr) == sorted(brute(pages, labelled), key=repr)


def test_visible_text(spark):
    pages = {"a<b": "a<b", "a<b>c<i": "a c<i", "<p>x &amp; y</p>z": " x   y z", "x<script>y": "x ", "x<STYLE a>y</style >z": "x z",
             "x<!-- <p>y": "x ", "<a href='x<y'>t</a>u": " t u", "5 < 6 and 7 > 2": "5   2", "": "", "plain": "plain",
             ">>": ">>", "x<script>a</script\n>b<!-->c-->d": "x b d", "<<p>>q": " >q", "\u00e9<b>\U0001f600": "\u00e9 \U0001f600"}
    docs = spark.createDataFrame(list(pages.items()) + [(None, None)], "html string, want string")
    for r in docs.select("want", language.visible(F.col("html")).alias("text")).collect():
        assert r.text == r.want


@pytest.mark.parametrize("unit", ["<!-- x ", "<script>x ", "<style>x ", "<a b ", "<script>x</script ", "&amp "])
def test_time_grows_with_the_page(spark, unit):
    """Four times a page of things never closed takes far less than sixteen times as long."""
    def seconds(n: int) -> float:
        page = spark.createDataFrame([(unit * n,)], "html string")
        start = time.perf_counter()
        page.select(F.length(language.visible(F.col("html"))), language.declared_in(F.col("html"))).collect()
        return time.perf_counter() - start
    seconds(1000)
    assert seconds(100_000) < 5 * seconds(25_000) + 1.0


def test_declared_language_is_found_anywhere(spark):
    pages = ["<!-- " + "x" * 5000 + ' <html lang="de"> --><html class="a" lang="da">', " " * 3000 + "<HTML LANG=da>",
             "<script>'<html lang=\"de\">'</script >" + "\n" * 3000 + "<html\nlang='da'>",
             "<html" * 200000 + ' lang="da">', "<p>", None, "<html><p lang='de'>"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(pages)], "i int, html string")
    rows = docs.select("i", language.declared_in(F.col("html")).alias("d")).orderBy("i").collect()
    assert [r.d for r in rows] == ["da"] * 4 + [None] * 3
