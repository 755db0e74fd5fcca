import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from laptrace.llm import quality
from laptrace.llm.words import Words


def base(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(ws, ws[1:], ws[2:]))
    cover = {k + d for k in range(len(ws) - 2) if windows[tuple(ws[k:k + 3])] > 1 for d in range(3)}
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(cover))


def test_base_counts(edge_docs, edge, no_docs):
    rows = quality.rules(edge_docs).collect()
    found = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows), key=repr)
    assert found == sorted(((i, *base(t)) for i, t, *_ in edge), key=repr)
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality.rules(no_docs).count() == 0 and quality.keep_good(no_docs).count() == 0


def test_lines_and_symbols():
    texts = ["a\n\na\n b\n b\na ", "x|y\r\nx|y\r\n", "\n\n", None, "é\né"]
    found = quality.base_counts(Words(pa.array(texts)))
    for k, text in enumerate(texts):
        assert tuple(int(v[k]) for v in found.values()) == base(text)


def test_distance():
    p, q = np.array([[1.0, 0, 3], [0, 0, 0]]), np.array([[0.0, 2, 2]])
    m = (p[0] / 4 + q[0] / 4) / 2
    want = sum(x / 4 * np.log2(x / 4 / y) for x, y in zip(p[0], m) if x) / 2
    want += sum(x / 4 * np.log2(x / 4 / y) for x, y in zip(q[0], m) if x) / 2
    assert quality.distance(p, q) == pytest.approx([np.sqrt(want), 0])
    assert quality.distance(p[:1], p[:1]) == pytest.approx([0], abs=1e-7)


def test_junk_goes_and_clean_stays(spark):
    rng = random.Random(2)
    common = ["the", "of", "and", "to", "in"]
    def clean(n=150):
        return " ".join(rng.choice(common) if rng.random() < 0.4 else
                        "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    rows = [(i, clean(), "en" if i % 10 else None, "clean") for i in range(200)]
    rows += [(1000 + i, clean().replace(" ", "%%% "), "en", "symbols") for i in range(5)]
    rows += [(2000 + i, " | ".join(w for w in clean(400).split() if w not in common), "en", "list") for i in range(5)]
    rows += [(3000 + i, clean(60), "xx", "clean") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kind string")
    kept = {r.doc_id for r in quality.rules(docs).collect() if r.kept}
    assert kept == {i for i, _, _, kind in rows if kind == "clean"}
    good = quality.keep_good(docs)
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == kept


def test_short_texts_are_not_judged_by_distance(spark):
    docs = spark.createDataFrame([(1, "%% " * 10, "en"), (2, "a b " * 100, "en")], "doc_id long, text string, lang string")
    rows = {r.doc_id: r for r in quality.rules(docs).collect()}
    assert rows[1].base_failed and rows[2].base_failed


def test_verdict_does_not_hang_on_a_languages_share(spark):
    rng = random.Random(5)
    latin = ["the", "of", "and", "to", "in"]
    greek = ["και", "το", "της", "που", "με"]
    def clean(common, letters, n):
        return " ".join(rng.choice(common) if rng.random() < 0.4 else
                        "".join(rng.choice(letters) for _ in range(6)) for _ in range(n))
    many = [(i, clean(latin, "abcdefgh", 60), "en") for i in range(6000)]
    few = [(10 ** 6 + i, clean(greek, "αβγδεζηθ", 500), "el") for i in range(5)]
    odd = [(10 ** 6 + 10, clean(greek, "αβγδεζηθ", 150), None), (10 ** 6 + 11, clean(greek, "αβγδεζηθ", 150), "xx")]
    junk = [(10 ** 6 + 20, clean(latin, "abcdefgh", 150), "el"), (10 ** 6 + 21, clean(greek, "αβγδεζηθ", 150), "en")]
    docs = spark.createDataFrame(many + few + odd + junk, "doc_id long, text string, lang string")
    alone = spark.createDataFrame(few + odd + junk[:1], docs.schema)
    rows = {r.doc_id: r for r in quality.rules(docs).filter(f"doc_id >= {10 ** 6}").collect()}
    assert all(rows[i].kept for i, *_ in few + odd) and not any(rows[i].kept for i, *_ in junk)
    assert rows[10 ** 6 + 10].class_distance == rows[10 ** 6 + 11].word_distance == 0
    want = {r.doc_id: r for r in quality.rules(alone).collect()}
    assert all(rows[i] == r for i, r in want.items())
    assert {r.doc_id for r in quality.keep_good(alone).collect()} == {i for i, *_ in few + odd}
