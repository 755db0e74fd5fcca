"""Joins that hold when one key has a third of the rows and when the small side is not small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from laptrace.session import fresh_path
from laptrace.sources.tables import materialise

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32
# Facts of one key that a task may meet before the key is salted.
HOT_ROWS = 1_000_000
# Words of a Bloom filter that may be broadcast (16 bytes each, more in a hash table), and keys one of them takes.
FILTER_WORDS = 1 << 21
KEYS_A_WORD = 4


def fits_broadcast(side: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measures a side (one aggregate, no row leaves the executors) against the broadcast bound."""
    width = F.lit(8 * len(side.columns))
    for field in side.schema.fields:
        if isinstance(field.dataType, StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif field.dataType.typeName() in ("array", "map", "struct"):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
    size = side.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return size["n"] <= max_rows and size["b"] <= max_bytes


def lookup_join(facts: DataFrame, dim: DataFrame, on: list[str], how: str = "left", *,
                salts: int = SALTS, measured: DataFrame | None = None, **bounds) -> DataFrame:
    """Joins facts to a dimension that has one row per key.

    A dimension proven small is broadcast: the facts are not shuffled at all.
    Otherwise the join is salted.  ``measured`` is a cheaper frame known to be at least
    as large as the dimension, for the size check.
    """
    if fits_broadcast(dim if measured is None else measured, **bounds):
        return facts.join(F.broadcast(dim), on, how)
    return salted_join(facts, dim, on, how, salts)


def salted_join(facts: DataFrame, dim: DataFrame, on: list[str], how: str = "left", salts: int = SALTS, *,
                hot_rows: int = HOT_ROWS, salt_by: list[str] | None = None) -> DataFrame:
    """Shuffled join that spreads the facts of a hot key over salts.

    Keys are counted first (combined before the shuffle).  Those with more than ``hot_rows`` facts, of
    which there can only be rows / hot_rows, have their dimension row repeated ``salts`` times and
    their facts dealt over the salts by a hash, which unlike a random salt is the same on a retry;
    all other keys are joined as they are.  ``salt_by`` names columns that tell the facts of a key
    apart, so that the others can be left unread; without it the whole row is hashed.
    """
    key = F.struct(*on)
    hot = facts.groupBy(key.alias("__k")).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_rows).select("__k")

    def marked(side: DataFrame, salt: Column) -> DataFrame:
        # at most rows / hot_rows keys
        seen = side.withColumn("__k", key).join(F.broadcast(hot.withColumn("__hot", F.lit(True))), "__k", "left")
        return seen.withColumn("__salt", salt).drop("__k", "__hot")

    by = F.pmod(F.xxhash64(*(salt_by or facts.columns)), F.lit(salts)).cast("int")
    salted = marked(facts, F.when(F.col("__hot"), by).otherwise(0))
    repeated = marked(dim, F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0)))))
    return salted.join(repeated, [*on, "__salt"], how).drop("__salt")


def pending(names: DataFrame, done: DataFrame, key: str, done_key: str | None = None,
            ignore_case: bool = False) -> DataFrame:
    """Distinct keys not yet processed.

    Both sides are reduced to distinct keys first (combined before the shuffle), so a
    key that was repeated often costs one row in the anti join.
    """
    fold = F.lower if ignore_case else (lambda c: c)
    todo = names.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
    seen = done.select(fold(F.col(done_key or key)).alias("__k")).where("__k is not null").distinct()
    return todo.withColumn("__k", fold(F.col(key))).join(seen, "__k", "left_anti").drop("__k")


def bloom_words(keys: DataFrame, key: str, words: int) -> DataFrame:
    """A Bloom filter of some keys as a table: word, mask.

    A key sets five bits of one word of 64, so a filter is one grouped ``bit_or``, combined before the
    shuffle, and a probe meets one row.  Words of which no key sets a bit have no row.
    """
    word, mask = _bits(F.col(key), words)
    return keys.select(word.alias("__word"), mask.alias("__mask")).groupBy("__word").agg(F.bit_or("__mask").alias("__mask"))


def _bits(key: Column, words: int) -> tuple[Column, Column]:
    """The word of a key and the bits it sets there."""
    picks, mask = F.xxhash64(key, F.lit(2)), F.lit(0).cast("long")
    for i in range(5):
        bit = F.shiftright(picks, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(words)), mask


def doubtful(rows: DataFrame, keys: DataFrame, key: str, words: int, flag: str) -> DataFrame:
    """Adds a flag to rows: false where the key is surely not among ``keys``, true where it may be."""
    word, mask = _bits(F.col(key), words)
    met = rows.withColumns({"__word": word, "__want": mask}).join(
        F.broadcast(bloom_words(keys, key, words)), "__word", "left")
    hit = F.col("__mask").bitwiseAND(F.col("__want")) == F.col("__want")
    return met.withColumn(flag, F.coalesce(hit, F.lit(False))).drop("__word", "__want", "__mask")


def without_done(rows: DataFrame, done: DataFrame, key: str, done_key: str | None = None, ignore_case: bool = False, *,
                 max_rows: int = BROADCAST_ROWS, max_words: int = FILTER_WORDS) -> DataFrame:
    """Whole rows whose key is not yet processed; rows without a key stay, rows repeated stay repeated.

    The distinct keys that are done are written once and counted.  Few enough are broadcast.  Above
    ``max_rows`` a Bloom filter of them is broadcast instead: rows it does not know are new for certain and
    stay where they are, only the others are shuffled to an exact, salted join.  Where the filter would
    need more than ``max_words`` words, all rows take that join.
    """
    fold = F.lower if ignore_case else (lambda c: c)
    seen = materialise(done.select(fold(F.col(done_key or key)).alias("__key")).where("__key is not null").distinct(),
                       fresh_path(rows.sparkSession, "done"))
    facts = rows.withColumn("__key", fold(F.col(key)))
    marked = seen.withColumn("__done", F.lit(True))
    words = -(-seen.count() // KEYS_A_WORD)
    if fits_broadcast(seen, max_rows):
        return facts.join(F.broadcast(seen), "__key", "left_anti").drop("__key")
    if words > max_words:
        kept = salted_join(facts, marked, ["__key"])
        return kept.where("__done is null").drop("__key", "__done")
    sorted_out = doubtful(facts, seen, "__key", max(words, 1), "__maybe")
    checked = salted_join(sorted_out.where("__maybe"), marked, ["__key"]).where("__done is null")
    return sorted_out.where("not __maybe").drop("__maybe", "__key").unionByName(checked.drop("__maybe", "__key", "__done"))


def append(batches: list[DataFrame]) -> DataFrame:
    """Stacks batches by column name; columns a batch lacks become null."""
    out = batches[0]
    for batch in batches[1:]:
        out = out.unionByName(batch, allowMissingColumns=True)
    return out
