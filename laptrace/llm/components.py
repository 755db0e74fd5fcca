"""Connected components of links, as DataFrame rounds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laptrace.llm.tables import stored

#: Links that one task contracts in memory.
LOCAL_LINKS = 500_000


def components(edges: DataFrame, local_links: int = LOCAL_LINKS) -> DataFrame:
    """(node, component) for every node of (a, b); the component is its smallest node.

    Every task first contracts its own links to stars, at most ``local_links`` of them.  If there is
    more than one task, rounds of large-star and small-star follow: every node links its larger
    neighbours, then its smaller ones, to its smallest neighbour, until each component is a star.  A
    round costs two grouped minima and joins, whatever the shape of the graph.  Null ends and loops
    are dropped.
    """
    links = stored(edges.select("a", "b").filter("a is not null and b is not null and a <> b").distinct(), "links")

    def smallest(both: DataFrame) -> DataFrame:
        return both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("low"))

    while True:
        tasks = -(-links.count() // local_links)
        links = stored(links.coalesce(max(tasks, 1)).mapInArrow(_contract, "a long, b long"), "links")
        if tasks <= 1 or _stars(links):
            break
        both = links.select(F.col("a").alias("n"), F.col("b").alias("m")).unionAll(
            links.select(F.col("b").alias("n"), F.col("a").alias("m")))
        large = both.filter("m > n").join(smallest(both).hint("merge"), "n").select(F.col("m").alias("a"), F.col("low").alias("b"))
        large = stored(large.filter("a <> b").distinct(), "large")  # a > b from here on
        down = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low"))
        small = large.withColumnRenamed("a", "n").join(down.hint("merge"), "n")
        links = stored(small.select(F.col("b").alias("a"), F.col("low").alias("b")).unionAll(
            down.select(F.col("n").alias("a"), F.col("low").alias("b"))).filter("a <> b").distinct(), "links")
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionAll(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _stars(links: DataFrame) -> bool:
    """Does every node either have one link to a smaller one, or none and only be linked to?"""
    ends = links.select(F.col("a").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionAll(
        links.select("b", F.lit(0), F.lit(1)))
    bad = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into")).filter("out + into > 1")
    return bad.isEmpty()


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task as stars around the smallest node of each of its components."""
    parent: dict[int, int] = {}

    def root(n: int) -> int:
        while (up := parent.setdefault(n, n)) != n:
            parent[n] = n = parent[up]
        return n

    for batch in batches:
        for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    stars = [(n, root(n)) for n in parent]
    stars = [(n, r) for n, r in stars if n != r]
    yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in stars], pa.int64()),
                                      pa.array([r for _, r in stars], pa.int64())], names=["a", "b"])
