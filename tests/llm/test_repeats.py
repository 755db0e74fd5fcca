import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from laptrace.llm import repeats


def brute(rows, window):
    """(doc_id, words, kept text) of rows of (doc_id, text), in the order of the operator."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    seen, out = set(), []
    for i, text in order:
        ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for k in range(len(ws) - window + 1):
            key = tuple(ws[k:k + window])
            if key in seen:
                gone |= set(range(k, k + window))
            seen.add(key)
        out.append((i, len(ws), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r.doc_id, r.n_words, r.kept_text) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("window", [3, 20, 25, 50])
def test_edge_rows(edge_docs, edge, window):
    found = repeats.repeats(edge_docs, window=window)
    assert got(found) == brute([(i, t) for i, t, *_ in edge], window)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text("ab ", max_size=80), min_size=1, max_size=8), st.integers(1, 20))
def test_small_alphabets(spark, texts, window):
    rows = list(enumerate(texts))
    assert got(repeats.repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=window)) == brute(rows, window)


def test_spans_are_what_goes(edge_docs):
    for r in repeats.repeats(edge_docs.withColumnRenamed("text", "body"), text="body").collect():
        assert sum(s["words"] for s in r.spans) == r.n_removed
        assert r.n_words - r.n_removed == len(re.findall(r"[^\x20\x09-\x0D]+", r.kept_text))


def test_whole_rows(spark, edge_docs, edge):
    out = repeats.without_repeats(edge_docs, length="n_chars")
    assert out.columns == edge_docs.columns and out.schema["n_chars"].dataType == edge_docs.schema["n_chars"].dataType
    rows = out.collect()
    assert len(rows) == len(edge) and all(r.chunk == "clash" for r in rows)
    texts = sorted((str(i), t) for i, t, *_ in edge if t is None or len(t.split()) < 20)
    assert [x for x in texts if x not in [(str(r.doc_id), r.text) for r in rows]] == []
    for r in rows:
        assert r.n_chars == (None if r.text is None else len(r.text))


def test_levels():
    assert repeats.levels(20) == [10, 20] and repeats.levels(25) == [13, 25] and repeats.levels(3) == [3]
    assert repeats.levels(64) == [8, 16, 32, 64]


def test_many_documents(spark):
    rng = random.Random(1)
    passage = " ".join(f"p{k}" for k in range(30))
    rows = []
    for i in range(300):
        body = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60))]
        body.insert(rng.randrange(len(body) + 1), passage if i % 3 else "x")
        rows.append((i * 7 % 300, " ".join(body)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(repeats.repeats(docs)) == brute(rows, 20)


def test_empty(no_docs):
    assert repeats.repeats(no_docs).count() == 0 and repeats.without_repeats(no_docs).count() == 0
