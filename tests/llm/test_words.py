import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from laptrace.llm import words as W

TEXT = st.text(alphabet="ab \n\t\x0b\x1c é日", max_size=40)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=6))
def test_words_and_hashes(texts):
    found = W.Words(pa.array(texts, pa.string()))
    want = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    assert found.counts.tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    assert [found.buf[a:b].tobytes() for a, b in zip(found.starts, found.ends)] == flat
    by_hash = dict(zip(found.hashes().tolist(), flat))
    assert len(by_hash) == len(set(flat))


def test_hash_does_not_depend_on_the_place():
    long = b"y" * (W.BLOCK + 5)
    texts = [b"abc", b"z" * (W.BLOCK - 2) + b" abc", long, b"q " + long]
    found = W.Words(pa.array(texts, pa.binary()))
    h = found.hashes()
    assert h[0] == h[2] and h[3] == h[5] and len(set(h.tolist())) == 4


def test_slices_keep_all_rows():
    batch = pa.record_batch({"text": pa.array(["a" * 10, None, "b" * 50, "", "c"])})
    parts = list(W.slices(batch, limit=12))
    assert sum((p["text"].to_pylist() for p in parts), []) == batch["text"].to_pylist() and len(parts) > 2


def test_lower_case_is_ascii_only():
    assert np.array_equal(W.Words(pa.array(["ABC É"]), lower=True).buf, np.frombuffer("abc É".encode(), np.uint8))
