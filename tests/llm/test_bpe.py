import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from laptrace.llm import bpe, wavelet
from laptrace.llm.queries import WORD_BPE
from laptrace.session import fresh_path

CODEC = bpe.Codec.of(bpe.model_of(WORD_BPE))
TEXT = st.text(alphabet="aAbBTtsSdD.,'!19 \n\t\x0b\x1céÉ̸́̈ßΣ日|<>-_", max_size=60)


def reference(text):
    return CODEC.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_same_ids_as_the_library(texts):
    for bits in (0, 1, 2, 4):
        ids, offsets = CODEC.encode(pa.array(texts), bits)
        for d, text in enumerate(texts):
            own = ids[offsets[d]: offsets[d + 1]]
            assert own.tolist() == reference(text)
            assert CODEC.decode(own).decode() == CODEC.tokenizer.decode(own.tolist(), skip_special_tokens=False)


def test_special_strings_and_long_words():
    texts = ["a<|endoftext|>b", "<|STARTOFTEXT|> x", "x" * 3000 + " " + "ab.c" * 500, ""]
    for bits in (0, 2):
        ids, offsets = CODEC.encode(pa.array(texts), bits)
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [reference(t) for t in texts]


def test_store_starts_anew_when_full(monkeypatch):
    monkeypatch.setattr(bpe, "STORE_CHUNKS", 3)
    for text in ("a b c d e f", "a b x y z", "a q r s"):
        assert CODEC.encode(pa.array([text]), 2)[0].tolist() == reference(text)


def test_encode_edge_rows(edge_docs, edge, no_docs):
    found = bpe.encode(edge_docs, WORD_BPE, outputs=("ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256"))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in found.collect())
    assert got == sorted((i is None, i or 0, reference(t or "")) for i, t, *_ in edge)
    for r in found.collect():
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert bpe.encode(no_docs, WORD_BPE).count() == 0


@pytest.mark.parametrize("n, top", [(0, 9), (1, 0), (511, 3), (512, 3), (513, 50000), (5000, 70000), (3000, 1)])
def test_wavelet_matrix(n, top):
    ids = np.random.default_rng(n).integers(0, top + 1, n).astype(np.uint32)
    matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids).to_bytes())
    assert (matrix.symbols() == ids).all() and (matrix.access(np.arange(n)) == ids).all()
    for symbol in {0, top, 1, *ids[:3].tolist(), 99999}:
        places = np.flatnonzero(ids == symbol)
        assert matrix.count(symbol) == len(places) and (matrix.occurrences(symbol) == places).all()
        for upto in (0, n // 3, n):
            assert matrix.rank(symbol, upto) == (ids[:upto] == symbol).sum()
    with pytest.raises(IndexError):
        matrix.select(0, np.array([matrix.count(0)]))


def test_shards_round_trip(spark, edge_docs, edge, no_docs):
    path = fresh_path(spark, "shards")
    wavelet.write(edge_docs, path, WORD_BPE, end_id=2, shard_tokens=200)
    rows = wavelet.documents(spark, path, with_ids=True).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((i for i, *_ in edge), key=lambda i: (i is not None, i or 0))
    assert sorted((str(r.doc_id), r.ids) for r in rows) == sorted((str(i), reference(t or "") + [2]) for i, t, *_ in edge)
    start = 0
    for r in rows:
        assert r.start == start and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    flat = [x for r in rows for x in r.ids]
    assert spark.read.parquet(path).count() > 5
    found = sorted(r.position for r in wavelet.occurrences(spark, path, 2).collect())
    assert found == [k for k, x in enumerate(flat) if x == 2]
    empty = fresh_path(spark, "shards")
    wavelet.write(no_docs, empty, WORD_BPE, end_id=2)
    assert wavelet.documents(spark, empty).count() == 0
