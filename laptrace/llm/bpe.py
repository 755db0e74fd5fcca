"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the last eight bytes cuts texts where the content says so, so passages shared by
documents fall into the same chunks wherever they stand.  A cut inside a word is a join to repair: the
window around it grows to the blanks on both sides, where pre-tokens always end, and is encoded anew as
a whole; there the ids agree exactly with those of the uncut text.  Every distinct chunk and every
distinct repaired window is encoded once by the library and then reused, across all documents a Python
worker sees; the store is bounded and starts anew when full.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laptrace.llm.tables import giving_back
from laptrace.llm.words import LOWER, SPACE, VALUES, Words, slices, span_hashes

#: A cut follows one byte in 2**CUT_BITS.
CUT_BITS = 2
#: Distinct chunks a task keeps, and the bytes they may take.
STORE_CHUNKS, STORE_BYTES = 3_000_000, 64 << 20

ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = True
MARK = np.zeros(256, bool)
MARK[33:127] = True
MARK &= ~ALNUM

#: Pre-tokens never hold a blank, and a run of letters or a digit never holds a mark.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def checked(model: str) -> None:
    """Raises unless blanks are certain token boundaries and case is folded, as this module relies on."""
    parts = json.loads(model)
    normal = [n["type"] for n in (parts.get("normalizer") or {}).get("normalizers", [])]
    split = [p for p in (parts.get("pre_tokenizer") or {}).get("pretokenizers", []) if p["type"] == "Split"]
    if normal != ["NFC", "Replace", "Lowercase"] or not split or split[0]["pattern"] != {"Regex": SPLIT}:
        raise ValueError("only tokenizers that drop blanks, fold case and split like word_bpe_49k.json are supported")


def folded(buf: np.ndarray) -> np.ndarray:
    """ASCII letters in lower case, but for those before a byte of another script.

    The tokenizer composes letters and accents before it folds case; a letter before an accent stays.
    """
    plain = np.ones(len(buf), bool)
    plain[:-1] = buf[1:] < 128
    return np.where(plain, LOWER[buf], buf)


def chunk_starts(words: Words, bits: int) -> np.ndarray:
    """Where chunks begin: runs of words between cuts, and words with a cut inside alone."""
    buf, n, s, e = words.buf, len(words.buf), words.starts, words.ends
    if not len(s):
        return s
    padded = np.concatenate([np.zeros(7, np.uint8), buf])
    window = np.ndarray((n,), "<u8", padded.data, 0, (1,))
    cut = (window * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits) == 0
    for k in range(7):  # the window must not reach into the text before
        at = words.offsets[:-1] + k
        cut[at[at < words.offsets[1:]]] = False
    upto = np.concatenate([[0], np.cumsum(cut)])
    inside = upto[e - 1] > upto[s]
    after = upto[np.append(s[1:], n)] > upto[e - 1]
    ends = after | inside
    ends[:-1] |= inside[1:]
    last = words.first[1:]
    ends[last[last > words.first[:-1]] - 1] = True
    return s[np.concatenate([[0], np.flatnonzero(ends[:-1]) + 1])]


def piece_starts(words: Words) -> np.ndarray:
    """Where words begin, and marks behind ASCII letters and digits: all certain token boundaries."""
    buf = words.buf
    begins = np.zeros(len(buf), bool)
    begins[words.starts] = True
    begins[1:] |= ALNUM[buf[:-1]] & MARK[buf[1:]]
    begins[words.offsets[1:-1][words.offsets[1:-1] < len(buf)]] &= ~SPACE[
        buf[words.offsets[1:-1][words.offsets[1:-1] < len(buf)]]]
    return np.flatnonzero(begins)


class Store:
    """Ids of chunks by hash: sorted keys, and the ids behind each other."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.keys, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.at, self.size, self.ids, self.used, self.count = (
            np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1 << 16, np.uint32), 0, 0)

    @property
    def nbytes(self) -> int:
        return sum(a.nbytes for a in (self.keys, self.slot, self.at, self.size, self.ids))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where there is none."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.slot[at], -1)

    def add(self, keys: np.ndarray, ids: list[list[int]]) -> None:
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(size.sum())
        if self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used + 2 * total, np.uint32)])
        self.ids[self.used: self.used + total] = np.fromiter((i for x in ids for i in x), np.uint32, total)
        self.at = np.concatenate([self.at, self.used + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.slot = np.insert(self.slot, where, np.arange(self.count, self.count + len(ids)))
        self.used, self.count = self.used + total, self.count + len(ids)


def ragged(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions at[0], at[0] + 1, ... for size[0] of them, then those of the next."""
    ends = np.cumsum(size)
    return np.repeat(at - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


class Codec:
    """A tokenizer with its stores, one for each Python worker."""

    _known: dict[int, "Codec"] = {}

    @classmethod
    def of(cls, model: str) -> "Codec":
        key = zlib.crc32(model.encode())
        if key not in cls._known:
            cls._known[key] = cls(model)
        return cls._known[key]

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        checked(model)
        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t["content"].lower() for t in json.loads(model)["added_tokens"]]
        self.stores: dict[int, Store] = {}
        self.tokens: list[bytes] | None = None

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and, with one more, where each text's ids begin; ``bits`` 0 cuts at words and marks."""
        words = Words(column)
        words.buf = folded(words.buf)
        starts = chunk_starts(words, bits) if bits else piece_starts(words)
        store = self.stores.setdefault(bits, Store())
        if store.count > STORE_CHUNKS or store.nbytes > STORE_BYTES:
            store.clear()
        hashes = span_hashes(words.buf, starts, VALUES)
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        slots = store.find(keys)
        new = slots < 0
        if new.any():
            ends = np.append(starts[1:], len(words.buf))
            bounds = words.offsets[np.searchsorted(words.offsets, starts[first[new]], side="right")]
            spans = zip(starts[first[new]].tolist(), np.minimum(ends[first[new]], bounds).tolist(), strict=True)
            data = words.buf.tobytes()
            store.add(keys[new], self._whole([data[a:b].decode() for a, b in spans]))
            slots = store.find(keys)
        slots = slots[inverse]
        size = store.size[slots]
        ids = store.ids[ragged(store.at[slots], size)]
        upto = np.concatenate([[0], np.cumsum(size)])
        offsets = upto[np.searchsorted(starts, words.offsets)]
        return self._repaired(column, words, ids, offsets)

    def _repaired(self, column: pa.Array, words: Words, ids: np.ndarray,
                  offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts with the string of a special token are encoded as a whole."""
        data = words.buf.tobytes()
        if not any(s.encode() in data for s in self.special):
            return ids, offsets
        parts = np.split(ids, offsets[1:-1])
        for d in range(len(parts)):
            if any(s.encode() in words.text(d) for s in self.special):
                parts[d] = np.array(self._whole([column[d].as_py()])[0], np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids, special tokens kept, in UTF-8."""
        if self.tokenizer.decoder is not None:
            return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False).encode()
        if self.tokens is None:  # without a decoder the library joins tokens by a blank
            self.tokens = [(self.tokenizer.id_to_token(i) or "").encode()
                           for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        return b" ".join(map(self.tokens.__getitem__, ids.tolist()))


OUTPUTS = {
    "ids": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32()), lambda codec, ids: ids.astype(np.int32)),
    "decoded": (T.StringType(), pa.string(), lambda codec, ids: codec.decode(ids).decode()),
    "n_tokens": (T.LongType(), pa.int64(), lambda codec, ids: len(ids)),
    "ids_sha256": (T.StringType(), pa.string(),
                   lambda codec, ids: hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest()),
    "decoded_sha256": (T.StringType(), pa.string(),
                       lambda codec, ids: hashlib.sha256(codec.decode(ids)).hexdigest()),
}


def model_of(path: str) -> str:
    """A tokenizer file, read on the driver; files of vocabularies are a few MB."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
           outputs: Sequence[str] = ("ids", "decoded"), bits: int = CUT_BITS) -> DataFrame:
    """doc_id and the asked outputs for every row: ids, decoded, n_tokens, ids_sha256, decoded_sha256.

    The ids are exactly those of the library on the whole text.  A null text counts as empty and has
    no ids; empty texts too; repeated rows and ids, null ids and ties are rows like any others; an
    empty table gives an empty result; other columns are not looked at.  A very long text is held as
    a whole by one task, as any value of a row is.
    """
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", kind)] + [T.StructField(o, OUTPUTS[o][0]) for o in outputs])
    model = docs.sparkSession.sparkContext.broadcast(model_of(path))
    checked(model.value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(model.value)
        codec.stores.clear()  # a worker outlives its tasks
        for batch in batches:
            for part in slices(batch):
                column = pc.fill_null(part["text"], "")
                ids, offsets = codec.encode(column, bits)
                each = [ids[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                made = [pa.array([OUTPUTS[o][2](codec, x) for x in each], OUTPUTS[o][1]) for o in outputs]
                yield pa.RecordBatch.from_arrays([part["doc_id"], *made], names=["doc_id", *outputs])
        codec.stores.clear()

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        giving_back(run), schema)
