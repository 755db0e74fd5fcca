"""A corpus pipeline of five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laptrace.llm import balance, bpe, near, quality, repeats
from laptrace.llm.queries import WORD_BPE
from laptrace.llm.tables import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, null and empty texts with them; an empty table stays empty, equal rows fare alike."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates (five-word shingles, similarity 0.8) the smallest id stays.

    Rows are told apart by id: rows repeated under one id stay or go together, rows with a null id all stay, as
    do null and empty texts.  An empty table stays empty.
    """
    gone = near.near_duplicates(docs, width=5, percent=80).filter("not kept").select("doc_id").distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    left = whole.join(gone, F.col("row")["doc_id"] == gone["doc_id"], "left_anti")
    return left.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words and more that started earlier are cut from the texts; all documents stay.

    Rows with a null id come first, those that share an id in order of their texts; null and empty texts stay as
    they are, an empty table stays empty.
    """
    return repeats.without_repeats(docs, window=20, length="n_chars")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, some not at all and some twice.

    A null source is a source, null and empty texts have size 0; rows that share an id are taken equally often; an
    empty table stays empty.
    """
    return balance.repeated(docs, balance.mix(docs, weights=(3, 1, 2), share=1.5, most=2.0))


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document of the mix: its ids' number and digest, and the digest of the decoded text.

    Null and empty texts have no ids; nulls and repeats of ids are passed on; an empty table gives an empty one.
    """
    return bpe.encode(docs, WORD_BPE, outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mix", source_mix),
    ("bpe_encode", bpe_encode),
]

#: Encoding with a public tokenizer is not expressible in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
