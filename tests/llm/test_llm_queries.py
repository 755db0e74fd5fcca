"""Registered queries against DuckDB where there is SQL, and the pipeline stage by stage."""

import importlib
import os
import re

import duckdb
import pytest

from laptrace.llm.queries import QUERIES, SQL, WORD_BPE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "pages"):
        con.sql(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    found = QUERIES[name](spark, SF_DIR)
    want = con.sql(SQL[name])
    columns = sorted(want.columns)
    assert columns == sorted(found.columns)
    assert sorted(map(repr, map(tuple, found.select(*columns).collect()))) == sorted(
        map(repr, want.select(*columns).fetchall()))


def test_one_query_for_each_operator():
    entry = importlib.import_module("__spark_entry__")
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in entry.queries() if re.match(r"op\d+_", n))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


def test_pipeline(spark):
    from test_bpe import reference
    from test_near import brute as near_brute
    from test_repeats import brute as repeat_brute

    import corpus_pipeline
    from laptrace.llm import quality
    from laptrace.llm.tables import stored, table

    docs = table(spark, SF_DIR, "documents")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF_DIR), name)
        steps[name] = (before, docs)
    for before, after in list(steps.values())[:-1]:
        assert after.schema.simpleString() == before.schema.simpleString()
    before, after = steps["quality_rules"]
    good = {r.doc_id for r in quality.rules(before).collect() if r.kept}
    assert {r.doc_id for r in after.collect()} == good
    before, after = steps["near_dedup"]
    groups = near_brute([(r.doc_id, r.text) for r in before.collect()], 5)
    assert {r.doc_id for r in after.collect()} == {i for i, _, c in groups if i == c}
    before, after = steps["substring_dedup"]
    want = {i: t for i, _, t in repeat_brute([(r.doc_id, r.text) for r in before.collect()], 20)}
    assert {r.doc_id: " ".join(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in after.collect()} == want
    assert all(r.n_chars == len(r.text) for r in after.collect())
    before, after = steps["source_mix"]
    ids = {r.doc_id for r in before.collect()}
    size = lambda f: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in f.collect())
    assert {r.doc_id for r in after.collect()} <= ids and abs(size(after) / size(before) - 1.5) < 0.1
    assert after.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= 2
    before, after = steps["bpe_encode"]
    assert sorted((r.doc_id, r.n_tokens) for r in after.collect()) == sorted(
        (r.doc_id, len(reference(r.text))) for r in before.collect())
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, after.collect()))
    assert os.path.exists(WORD_BPE)
