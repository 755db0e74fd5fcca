import random

import pytest

CLASHES = ["chunk", "bucket", "size", "kept", "n_words", "row", "key", "rep", "class", "text_a", "registers",
           "mix_copies_", "part", "seq", "dim", "block", "ids", "held_out", "codes"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", "", ".", ",\n"]) for _ in range(n))


def edge_rows():
    """Nulls in any column, empty and blank texts, ties, repeated rows, copies, a long text, odd blanks."""
    rng = random.Random(3)
    base, passage, long = words(rng, 120), words(rng, 40), words(rng, 30000)
    changed = base.replace(base.split()[60], "other", 1)
    rows = [
        (5, base, "en", "a"), (2, base, "en", "a"), (9, changed, "en", None), (3, base.upper(), None, "b"),
        (7, None, "en", "b"), (8, "", "fr", None), (10, " \n\t\x0b\x0c\r ", "fr", "c"), (11, "one", None, "c"),
        (12, "one", "xx", ""), (13, "two words", "en", "é"), (14, "a b a b a b a b a b a b a b a b a b a b a b a b", "en", "z"),
        (None, base, "en", "a"), (None, None, None, None), (20, words(rng, 60) + " " + passage, "en", "a"),
        (21, passage + "\n" + words(rng, 70), "en", "b"), (22, passage + " " + passage, "de", "b"),
        (30, long, "en", "a"), (31, long + " end", "en", "a"), (40, "x" * 5000, "en", "a"), (41, "x" * 5001, "en", "a"),
        (50, words(rng, 80), "en", "a"), (50, words(rng, 80), "en", "b"), (60, words(rng, 55), "en", "a"),
        (60, words(rng, 55).replace("w", "ü"), "en", "a"),
        (70, "café T̈he 日本語 <|endoftext|> x", "fr", "a"), (-4, words(rng, 20), "en", "a"),
    ]
    rows.append(rows[-3])
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def edge(spark):
    return edge_rows()


@pytest.fixture(scope="session")
def edge_docs(spark, edge):
    """The rows as a table, dealt over three partitions, with extra columns whose names clash."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(edge, SCHEMA).repartition(3)
    return frame.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
