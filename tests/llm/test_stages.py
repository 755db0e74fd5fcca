"""Every pipeline stage on edge rows with clashing and dotted columns, and on an empty table."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from laptrace.llm.tables import stored

MORE = ["reference_", "reference_lang_", "lang_", "mix_id_", "mix_copies_", "row", "odd.name", "col"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_edge_rows_and_no_rows(edge_docs, edge, no_docs, name, stage):
    docs = edge_docs.withColumns({c: F.lit("clash") for c in MORE})
    found = stage(docs.sparkSession, docs, None)
    if name == "bpe_encode":
        assert found.count() == len(edge) and stage(docs.sparkSession, no_docs, None).count() == 0
        return
    assert found.schema.simpleString() == docs.schema.simpleString()
    kept = ["doc_id", "lang", "source"]
    rows = found.select(*kept, "text", *[f"`{c}`" for c in MORE]).collect()
    assert all(r[c] == "clash" for r in rows for c in MORE)
    given = {(i, lang, s): t for i, t, lang, s, _ in edge}
    assert {tuple(r[c] for c in kept) for r in rows} <= set(given)
    if name in ("quality_rules", "near_dedup", "source_mix"):
        assert all(r.text in [t for i, t, lang, s, _ in edge if (i, lang, s) == (r.doc_id, r.lang, r.source)] for r in rows)
    if name == "substring_dedup":
        assert len(rows) == len(edge)
    if name == "near_dedup":
        assert sum(r.doc_id is None for r in rows) == 2 and {9, 5} & {r.doc_id for r in rows} == set()
    empty = stored(stage(docs.sparkSession, no_docs, None), name)
    assert empty.count() == 0 and empty.schema.simpleString() == no_docs.schema.simpleString()
