"""Passages that repeat across documents or inside one, found by level-wise doubling.

Windows of a short length are compared first.  Only windows that repeat are extended to twice the
length (or as far as the asked length goes), the halves of a longer window being repeated windows
of the level before; at the asked length the first occurrence is found and all later ones are
marked.  Each level is one exchange between chunks of documents and buckets of window hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laptrace.llm.exchange import Buckets, chunked, narrow, widened
from laptrace.llm.tables import give_back
from laptrace.llm.words import Words, mixed

#: MB of text that a chunk holds; a task takes some eight times that.
CHUNK_MB = 8
#: Windows are not halved below this many words.
SHORTEST = 8
#: Bits of a hash that a level below the asked length compares within a bucket (40 with rounding).
ROUGH = 39
#: 64-bit hashes decide at the asked length; more bits would only guard against chance collisions.
_STEP = 0xD1342543DE82EF95

QUESTION = "chunk int, bucket int, n int, keys binary, width int, ids binary, id_base long, id_width int, " \
           "at binary, at_width int"
ANSWER = "chunk int, bucket int, level int, n int, bits binary"


def levels(window: int) -> list[int]:
    """Lengths from short to ``window``, each at most twice the one before."""
    found = [window]
    while -(-found[0] // 2) >= SHORTEST:
        found.insert(0, -(-found[0] // 2))
    return found


class Chunk:
    """The documents of a chunk in order of their ids, nulls first and equal ids by text."""

    def __init__(self, table: pa.Table):
        keys = [("doc_id", "ascending"), ("text", "ascending")]
        self.table = table.take(pa.compute.sort_indices(table.select(["doc_id", "text"]), sort_keys=keys,
                                                        null_placement="at_start"))
        self.words = Words(self.table["text"])
        self.own = self.words.hashes()

    def windows(self, length: int) -> np.ndarray:
        """First words of all windows of a length."""
        own = np.maximum(self.words.counts - length + 1, 0)
        ends = np.cumsum(own)
        return np.repeat(self.words.first[:-1] - (ends - own), own) + np.arange(int(ends[-1]) if len(ends) else 0)

    def hashes(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the windows of a length that begin at the given words: a polynomial over the words' hashes."""
        out, have, piece, k, left = None, 0, self.own, 1, length
        while left:  # ``piece`` covers k words, ``out`` the first ``have`` of the window
            if left & 1:
                out, have = piece if out is None else _joined(out, piece, have), have + k
            left >>= 1
            if left:
                piece, k = _joined(piece, piece, k), 2 * k
        return mixed(out[at])


def _joined(head: np.ndarray, tail: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k words and those behind them, for every place; windows that leave the chunk are not meant."""
    out = head.copy()
    if k < len(out):
        out[:-k] += tail[k:] * np.uint64(pow(_STEP, k, 1 << 64))
    return out


def _candidates(chunk: Chunk, lengths: list[int], answers: pa.Table, buckets: Buckets) -> np.ndarray:
    """First words of the windows of the next level whose parts all repeat, from the levels' answers."""
    at = chunk.windows(lengths[0])
    for level, (length, longer) in enumerate(zip(lengths, lengths[1:], strict=False)):
        if len(answers) == 0 or level >= answers_levels(answers):
            break
        hashes = chunk.hashes(at, length)
        keys, inverse, counts = np.unique(buckets.cut(hashes), return_inverse=True, return_counts=True)
        elsewhere = _bits(answers, level, len(keys))
        repeated = np.zeros(len(chunk.words) + 1, bool)
        repeated[at] = ((counts > 1) | elsewhere)[inverse]
        starts = chunk.windows(longer)
        at = starts[repeated[starts] & repeated[starts + longer - length]]
    return at


def answers_levels(answers: pa.Table) -> int:
    return int(pa.compute.max(answers["level"]).as_py()) + 1


def _bits(answers: pa.Table, level: int, n: int) -> np.ndarray:
    """The answers of a level in the order of the keys that were asked."""
    rows = [r for r in answers.select(["bucket", "level", "n", "bits"]).to_pylist() if r["level"] == level]
    rows.sort(key=lambda r: r["bucket"])
    parts = [np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["n"]).view(bool) for r in rows]
    out = np.concatenate(parts) if parts else np.zeros(0, bool)
    if len(out) != n:
        raise ValueError("answers do not fit the questions")
    return out


def _rough(lengths: list[int], level: int, buckets: Buckets):
    """Asks which windows of a level also stand in other chunks."""
    def ask(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(docs)
        at = _candidates(chunk, lengths[: level + 1], answers, buckets)
        keys = np.unique(buckets.cut(chunk.hashes(at, lengths[level])))
        rows = [_question(key[0].as_py(), b, keys[lo:hi] - buckets.base(b)) for b, lo, hi in buckets.split(keys)]
        del chunk, at, keys
        give_back()
        return pa.Table.from_pylist(rows, _QUESTION)
    return ask


def _question(chunk: int, bucket: int, keys: np.ndarray, ids: np.ndarray | None = None,
              at: np.ndarray | None = None) -> dict:
    packed, width = narrow(keys)
    row = {"chunk": chunk, "bucket": bucket, "n": len(keys), "keys": packed, "width": width}
    if ids is not None:
        low = int(ids.min())
        row["ids"], row["id_width"] = narrow(ids.view(np.uint64) - np.uint64(low % (1 << 64)))
        row["at"], row["at_width"] = narrow(at.astype(np.uint64))
        row["id_base"] = low
    return row


_QUESTION = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()),
                       ("width", pa.int32()), ("ids", pa.binary()), ("id_base", pa.int64()), ("id_width", pa.int32()),
                       ("at", pa.binary()), ("at_width", pa.int32())])
_ANSWER = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("level", pa.int32()), ("n", pa.int32()),
                     ("bits", pa.binary())])


def _exact(lengths: list[int], buckets: Buckets, full: Buckets):
    """Asks, for each window of the asked length, whether another chunk has it earlier."""
    def ask(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(docs)
        at = _candidates(chunk, lengths, answers, buckets)
        keys, first = np.unique(chunk.hashes(at, lengths[-1]), return_index=True)
        doc = np.searchsorted(chunk.words.first, at[first], side="right") - 1
        ids = np.asarray(pa.compute.fill_null(chunk.table["doc_id"], np.iinfo(np.int64).min)).astype(np.int64)[doc]
        place = at[first] - chunk.words.first[doc]
        rows = [_question(key[0].as_py(), b, keys[lo:hi] - full.base(b), ids[lo:hi], place[lo:hi])
                for b, lo, hi in full.split(keys)]
        del chunk, at, keys, first, doc, ids, place
        give_back()
        return pa.Table.from_pylist(rows, _QUESTION)
    return ask


def _judge(level: int, exact: bool):
    """Answers a bucket's questions: is the key in another chunk, or, if ``exact``, earlier in another."""
    def answer(questions: pa.Table) -> pa.Table:
        rows = questions.to_pylist()
        keys = np.concatenate([widened(r["keys"], r["width"]) for r in rows])
        if exact:
            ids = np.concatenate([(widened(r["ids"], r["id_width"]) + np.uint64(r["id_base"] % (1 << 64))).view(np.int64)
                                  for r in rows])
            at = np.concatenate([widened(r["at"], r["at_width"]) for r in rows])
            order = np.lexsort((at, ids, keys))
        else:
            order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        same = ordered[1:] == ordered[:-1]
        hit = np.zeros(len(keys), bool)
        hit[order[1:]] = same
        if not exact:
            hit[order[:-1]] |= same
        ends = np.cumsum([r["n"] for r in rows])
        parts = np.split(hit, ends[:-1])
        return pa.table({"chunk": [r["chunk"] for r in rows], "bucket": [r["bucket"] for r in rows],
                         "level": [level] * len(rows), "n": [r["n"] for r in rows],
                         "bits": [np.packbits(p).tobytes() for p in parts]}, schema=_ANSWER)
    return answer


def _remove(lengths: list[int], buckets: Buckets, schema: pa.Schema):
    window = lengths[-1]

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(docs)
        words, n = chunk.words, len(chunk.words)
        rough = answers.filter(pa.compute.less(answers["level"], len(lengths) - 1))
        at = _candidates(chunk, lengths, rough, buckets)
        keys, first, inverse = np.unique(chunk.hashes(at, window), return_index=True, return_inverse=True)
        later = _bits(answers, len(lengths) - 1, len(keys))[inverse]
        later |= first[inverse] != np.arange(len(at))
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, at[later], 1)
        np.add.at(change, at[later] + window, -1)
        gone = np.cumsum(change[:-1]) > 0
        text, removed = _kept(words, gone)
        edge = np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))
        # a covered run may reach over the end of a text into the next one
        lead = gone.copy()
        lead[1:] &= ~gone[:-1]
        heads = words.first[:-1][words.first[:-1] < n]
        lead[heads] = gone[heads]
        begin = np.flatnonzero(lead)
        stop = np.append(np.flatnonzero(edge == -1), n)
        bound = words.first[np.searchsorted(words.first, begin, side="right")]
        end = np.minimum(stop[np.searchsorted(stop, begin, side="right")], bound) if len(begin) else begin
        doc = np.searchsorted(words.first, begin, side="right") - 1
        spans = [[] for _ in range(len(words.counts))]
        for d, a, b in zip(doc.tolist(), (begin - words.first[doc]).tolist(), (end - begin).tolist(), strict=True):
            spans[d].append({"start": a, "words": b})
        columns = {"n_words": pa.array(words.counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                   "spans": pa.array(spans, schema.field("spans").type), "kept_text": text}
        out = [columns[f.name] if f.name in columns else chunk.table[f.name].combine_chunks().cast(f.type)
               for f in schema]
        del chunk, words, at, keys, first, inverse, later, change, gone, text, columns
        give_back()
        return pa.Table.from_arrays(out, schema=schema)
    return run


def _kept(words: Words, gone: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Each text's kept words joined by one blank, and the number of words it lost."""
    docs = words.docs()
    removed = np.bincount(docs[gone], minlength=len(words.counts))
    left = np.flatnonzero(~gone)
    follows = np.zeros(len(left), bool)
    follows[:-1] = docs[left[1:]] == docs[left[:-1]]
    mask = np.zeros(len(words.buf) + 2, np.int8)
    mask[words.starts[left]] += 1
    mask[words.ends[left] + follows] -= 1
    mask = np.cumsum(mask[:-2], dtype=np.int8) > 0
    # a word right behind the blank after another one: +1 and -1 fall on one place and cancel out
    data = np.where(mask & np.isin(words.buf, (9, 10, 11, 12, 13)), np.uint8(32), words.buf)[mask]
    size = np.bincount(docs[left], weights=words.ends[left] - words.starts[left] + follows,
                       minlength=len(words.counts)).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    text = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes()))
    return text.cast(pa.string()), removed


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20,
            carry: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, spans, kept_text for every row; with ``carry`` the whole row as ``row``.

    A word goes if a window of ``window`` words over it also starts earlier: in a row with a smaller
    id, or before in the same text.  Windows are compared on the input.  ``spans`` are the runs that
    go, (start, words) in words; ``kept_text`` has the rest joined by one blank.

    Null and empty texts have no words; texts shorter than a window lose nothing.  Rows with equal ids
    follow each other in order of their texts, rows with a null id come before all others; an empty
    table gives an empty result; other columns are not looked at.  Chunks hold whole texts, so one
    very long text is the least a task holds.
    """
    lengths = levels(window)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    narrow_docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                              *[F.struct(*others).alias("row")] * carry)
    dealt, parts = chunked(narrow_docs, "doc_id", mb_each=CHUNK_MB, measured=True)
    dealt = dealt.select("chunk", "doc_id", "text", *["row"] * carry)
    rough, full = Buckets(parts, ROUGH), Buckets(parts)
    spark = docs.sparkSession
    answers = spark.createDataFrame([], ANSWER)
    for level in range(len(lengths) - 1):
        asked = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
            _rough(lengths, level, rough), QUESTION) if level else dealt.groupBy("chunk").applyInArrow(
            _alone(_rough(lengths, level, rough)), QUESTION)
        answers = answers.unionAll(asked.groupBy("bucket").applyInArrow(_judge(level, False), ANSWER)) if level else (
            asked.groupBy("bucket").applyInArrow(_judge(level, False), ANSWER))
    if len(lengths) > 1:
        asked = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
            _exact(lengths, rough, full), QUESTION)
        exact = asked.groupBy("bucket").applyInArrow(_judge(len(lengths) - 1, True), ANSWER)
        answers = answers.unionAll(exact)
    else:
        asked = dealt.groupBy("chunk").applyInArrow(_alone(_exact(lengths, rough, full)), QUESTION)
        answers = asked.groupBy("bucket").applyInArrow(_judge(0, True), ANSWER)
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("words", T.IntegerType())]))
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
              T.StructField("n_removed", T.LongType()), T.StructField("spans", span),
              T.StructField("kept_text", T.StringType())]
    if carry:
        fields += [T.StructField("text", T.StringType()), dealt.schema["row"]]
    schema = T.StructType(fields)
    from pyspark.sql.pandas.types import to_arrow_schema

    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _remove(lengths, rough, to_arrow_schema(schema)), schema)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20,
                    length: str | None = None) -> DataFrame:
    """The rows with all their columns and the repeated passages cut from their texts.

    Texts that lose nothing stay as they are, others are their kept words joined by one blank; a column
    named by ``length`` gets the new number of characters.  Null texts stay null; nulls, repeated rows and ids and
    empty tables are as in :func:`repeats`.
    """
    found = repeats(docs, doc_id, text, window, carry=True)
    new = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    columns = {c: F.col("row")[c] for c in docs.columns if c != text} | {text: new}
    if length:
        columns[length] = F.char_length(new).cast(docs.schema[length].dataType)
    return found.select(*[columns[c].alias(c) for c in docs.columns])


def _alone(ask):
    """A question without answers yet."""
    empty = _ANSWER.empty_table()

    def run(key: tuple, docs: pa.Table) -> pa.Table:
        return ask(key, docs, empty)
    return run
