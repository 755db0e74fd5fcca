"""Quality rules: how far a document's characters and common words stray from its language.

Two histograms are compared with a reference of the document's language by Jensen-Shannon distance:
shares of character classes, and shares of the language's commonest words among all words.  Short
documents are not judged by a distance they can't support, nor any by a reference of too few words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laptrace.llm.tables import giving_back, stored
from laptrace.llm.words import LOWER, SPACE, VALUES, WORD_VALUES, Words, pair_hash, slices, span_hashes

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Common words of a reference; the rest is one more bin.
COMMON = 40
#: Documents with fewer words, or fewer characters in words, are not judged by the distance in question.
WORDS_GUARD, CHARS_GUARD = 50, 300
#: Distances above which a document is rejected; 0 for equal and 1 for disjoint histograms.
MOST_CLASS_DISTANCE, MOST_WORD_DISTANCE = 0.28, 0.40
#: A histogram of n words strays by chance; this much divided by the root of n is allowed on top.
CHANCE = 0.5
#: A reference of fewer words strays by chance itself and judges no document.
LEAST_REFERENCE = 2000
#: Distinct words a task gathers before it passes its counts on.
GATHERED = 1_000_000

#: Classes of bytes: lower case, upper case, digits, blanks, sentence marks, symbols, other marks,
#: first bytes of characters outside ASCII, control characters; -1 for the later bytes of a character.
CLASSES = 9
CLASS = np.full(256, 8, np.int8)
CLASS[97:123], CLASS[65:91], CLASS[48:58] = 0, 1, 2
CLASS[[9, 10, 11, 12, 13, 32]] = 3
CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 4
CLASS[[ord(c) for c in "#*$%&|<>=+~^@\\/_{}[]`"]] = 5
CLASS[128:192], CLASS[192:256] = 6, 7
SYMBOL = np.zeros(256, bool)
SYMBOL[list(SYMBOLS)] = True


def class_counts(words: Words) -> np.ndarray:
    """Characters of each class for each text, in the order of CLASS; blanks and control characters do not count."""
    kinds, out = CLASS[words.buf], np.zeros((len(words.offsets) - 1, CLASSES), np.int64)
    for c in range(CLASSES):
        if c not in (3, 6, 8):
            out[:, c] = _within(words, kinds == c)
    return out


def _within(words: Words, flags: np.ndarray) -> np.ndarray:
    """Bytes with a flag in each text."""
    upto = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(upto[words.offsets])


#: Marks count nothing in a bare word, so "the" and "the." are one.
BARE = WORD_VALUES.copy()
BARE[[b for b in range(33, 127) if not chr(b).isalnum()]] = 0


def bare_hashes(words: Words) -> np.ndarray:
    """Hash of each word in lower case and without marks behind it."""
    return span_hashes(LOWER[words.buf], words.starts, BARE)


def base_counts(words: Words) -> dict[str, np.ndarray]:
    """The counts of the base rules for each text."""
    starts_char = CLASS[words.buf] != 6
    n_words, docs = words.counts, words.docs()
    # lines: from the start of a text or behind a line feed, which itself counts nothing
    begins = np.zeros(len(words.buf), bool)
    begins[1:] = words.buf[:-1] == 10
    begins[words.offsets[:-1][words.offsets[:-1] < len(words.buf)]] = True
    lines = np.flatnonzero(begins)
    owner = np.searchsorted(words.offsets, lines, side="right") - 1
    held = np.diff(np.searchsorted(words.starts, np.append(lines, len(words.buf)))) > 0
    lines, owner = lines[held], owner[held]
    key = pair_hash(_line_hashes(words, begins, held), owner.astype(np.uint64))
    _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    again = first[inverse] != np.arange(len(key))
    # windows of three words
    hashes = words.hashes()
    covered = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes) > 2:
        at = np.flatnonzero(docs[2:] == docs[:-2])
        window = pair_hash(pair_hash(pair_hash(hashes[at], hashes[at + 1]), hashes[at + 2]), docs[at].astype(np.uint64))
        _, inverse, times = np.unique(window, return_inverse=True, return_counts=True)
        twice = at[times[inverse] > 1]
        covered[twice] += 1
        np.add.at(covered, twice + 3, -1)
    repeated = np.cumsum(covered[:-1]) > 0
    number = len(n_words)
    return {"n_words": n_words, "word_chars": _within(words, starts_char & ~SPACE[words.buf]),
            "n_symbols": _within(words, SYMBOL[words.buf]),
            "n_dup_lines": np.bincount(owner[again], minlength=number),
            "n_repeat_words": np.bincount(docs[repeated], minlength=number)}


def _line_hashes(words: Words, begins: np.ndarray, held: np.ndarray) -> np.ndarray:
    values = VALUES.copy()
    values[10] = 0
    return span_hashes(words.buf, np.flatnonzero(begins), values)[held]


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, of rows of counts to one row of counts each; 0 for an empty row."""
    p = p / np.maximum(p.sum(axis=1, keepdims=True), 1)
    q = q / np.maximum(q.sum(axis=1, keepdims=True), 1)
    m = (p + q) / 2

    def part(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log2(np.maximum(x, 1e-300) / np.maximum(m, 1e-300)), 0).sum(axis=1)

    found = np.sqrt(np.maximum((part(p) + part(q)) / 2, 0))
    return np.where((p.sum(axis=1) > 0) & (q.sum(axis=1) > 0), found, 0.0)


def _by_language(langs: list, docs: np.ndarray) -> Iterator[tuple]:
    """Each language with its texts and with its words, as positions; ``docs`` are the words' texts."""
    names = {x: k for k, x in enumerate(dict.fromkeys(langs))}
    code = np.array([names[x] for x in langs], np.int64)
    texts, words = np.argsort(code, kind="stable"), np.argsort(code[docs], kind="stable")
    upto = np.arange(len(names) + 1)
    t, w = np.searchsorted(code[texts], upto), np.searchsorted(code[docs][words], upto)
    for lang, k in names.items():
        yield lang, texts[t[k]:t[k + 1]], words[w[k]:w[k + 1]]


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of character classes and bare words for each language."""
    def rows(kind: int, counts: dict) -> Iterator[pa.RecordBatch]:
        for lang, (keys, numbers) in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array([kind] * len(keys), pa.int32()),
                 pa.array(keys.view(np.int64) if kind == WORD else keys, pa.int64()), pa.array(numbers, pa.int64())],
                names=["lang", "kind", "key", "n"])

    held: dict = {}
    for batch in batches:
        for part in slices(batch):
            words = Words(part["text"])
            classes, hashes, small = class_counts(words), bare_hashes(words), {}
            for lang, texts, mine in _by_language(part["lang"].to_pylist(), words.docs()):
                small[lang] = (np.arange(CLASSES), classes[texts].sum(axis=0))
                keys, times = np.unique(hashes[mine], return_counts=True)
                if lang in held:
                    keys, at = np.unique(np.concatenate([held[lang][0], keys]), return_inverse=True)
                    times = np.bincount(at, weights=np.concatenate([held[lang][1], times])).astype(np.int64)
                held[lang] = (keys, times)
            yield from rows(CHAR, small)
            if sum(len(k) for k, _ in held.values()) > GATHERED:
                yield from rows(WORD, held)
                held = {}
    yield from rows(WORD, held)


CHAR, WORD = 1, 2


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """reference_lang_ and reference_ (class counts, common words, their counts, all words) for each language.

    Everything is counted over all documents, whatever their language's share; only null languages and
    those with fewer than LEAST_REFERENCE words have no reference.  An empty table gives an empty one.
    """
    narrow = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    counted = stored(narrow.filter("lang is not null").mapInArrow(giving_back(_gather), "lang string, kind int, key long, n long")
                     .groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")), "language_counts")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "key"))
    words = counted.filter(F.col("kind") == WORD)
    enough = words.groupBy("lang").agg(F.sum("n").alias("words")).filter(F.col("words") >= LEAST_REFERENCE)
    # COMMON words and CLASSES classes for each language
    common = words.withColumn("place", place).filter(F.col("place") <= COMMON).drop("place")
    listed = counted.filter(F.col("kind") == CHAR).unionByName(common).groupBy("lang").agg(*[
        F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("key", "n")))).alias(name)
        for kind, name in ((CHAR, "classes"), (WORD, "common"))])
    return stored(listed.join(enough, "lang").select(
        F.col("lang").alias("reference_lang_"), F.struct(
            F.col("classes.n").alias("classes"), F.col("common.key").alias("keys"),
            F.col("common.n").alias("counts"), "words").alias("reference_")), "references")


def _with_references(docs: DataFrame, known: DataFrame, lang: str) -> DataFrame:
    """The rows with their language's reference, null without one; a short table of references is broadcast."""
    return docs.join(known, F.col(lang).cast("string") == known["reference_lang_"], "left")


def measured(words: Words, langs: list, known: pa.Array) -> dict[str, np.ndarray]:
    """Counts, distances and verdicts for a slice of texts; ``known`` has each text's reference or null."""
    out = base_counts(words)
    n = out["n_words"]
    classes, hashes, docs = class_counts(words), bare_hashes(words), words.docs()
    far_class, far_words = np.zeros(len(n)), np.zeros(len(n))
    for _, own, mine in _by_language(langs, docs):
        reference = known[int(own[0])].as_py()
        if reference is None:
            continue
        far_class[own] = distance(classes[own].astype(float), np.array(reference["classes"], float)[None, :])
        keys, counts = np.array(reference["keys"], np.int64).view(np.uint64), np.array(reference["counts"], np.int64)
        order = np.argsort(keys)
        keys = keys[order]
        share = np.append(counts[order], reference["words"] - counts.sum()).astype(float)
        at = np.minimum(np.searchsorted(keys, hashes[mine]), len(keys) - 1)
        bins = np.where(keys[at] == hashes[mine], at, len(keys))
        cells = np.bincount(np.searchsorted(own, docs[mine]) * len(share) + bins, minlength=len(own) * len(share))
        far_words[own] = distance(cells.reshape(len(own), -1).astype(float), share[None, :])
    failed = (n < LEAST_WORDS) | (100 * out["n_repeat_words"] > MOST_REPEATED * n)
    strange = (classes.sum(axis=1) >= CHARS_GUARD) & (far_class > MOST_CLASS_DISTANCE)
    strange |= (n >= WORDS_GUARD) & (far_words > MOST_WORD_DISTANCE + CHANCE / np.sqrt(np.maximum(n, 1)))
    return out | {"class_distance": far_class, "word_distance": far_words, "base_failed": failed,
                  "kept": ~failed & ~strange}


MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "class_distance double, word_distance double, base_failed boolean, kept boolean")
TYPES = {"class_distance": pa.float64(), "word_distance": pa.float64(), "base_failed": pa.bool_(), "kept": pa.bool_()}


def rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          known: DataFrame | None = None) -> DataFrame:
    """doc_id and the measures of every row, ``kept`` being the verdict.

    A document fails the base rules with fewer than 50 words, or more than half of its words in
    windows of three that occur twice.  Others are rejected for a Jensen-Shannon distance to their
    language's reference above the limit, of character classes (from 300 characters on) or of common
    words (from 50 words on, with an allowance for chance).

    Null and empty texts have no words and fail; documents of a null language, or one with fewer than
    LEAST_REFERENCE words in all, go by the base rules alone and have distances of 0; ids are passed on
    as they are, nulls and repeats included; other columns are not looked at; an empty table gives an
    empty result.
    """
    known = references(docs, text, lang) if known is None else known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = measured(Words(part["text"]), part["lang"].to_pylist(), part["reference_"])
                columns = [pa.array(v, TYPES.get(k, pa.int64())) for k, v in found.items()]
                yield pa.RecordBatch.from_arrays([part["doc_id"], *columns], names=["doc_id", *found])

    kind = docs.schema[doc_id].dataType.simpleString()
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"),
                         F.col(lang).cast("string").alias("lang"))
    return _with_references(narrow, known, "lang").mapInArrow(
        giving_back(run), f"doc_id {kind}, {MEASURES}")


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows, with all their columns, that the rules keep; one pass, no shuffle of texts
    as long as the references are short enough for Spark to broadcast.

    Null and empty texts go, as in :func:`rules`; null languages are judged by the base rules alone; of repeated rows
    each is judged; an empty table stays empty.  Columns may have any name.
    """
    known = references(docs, text, lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = measured(Words(part["text"]), part["lang"].to_pylist(), part["reference_"])
                rest = part["row"].filter(pa.array(found["kept"]))
                own = [rest.field(k) if k != at else part["text"].filter(pa.array(found["kept"])).cast(rest.type.field(k).type)
                       for k in range(len(names))]
                yield pa.RecordBatch.from_arrays(own, names=names)

    names, at = docs.columns, docs.columns.index(text)
    # the row travels as a struct, its text beside it
    row = F.struct(*[F.lit(None).cast(docs.schema[c].dataType).alias(c) if c == text else F.col(f"`{c}`") for c in names])
    carried = docs.select(row.alias("row"), F.col(f"`{text}`").cast("string").alias("text"),
                          F.col(f"`{lang}`").cast("string").alias("lang"))
    return _with_references(carried, known, "lang").mapInArrow(giving_back(run), docs.schema)
