import itertools
import re

from pyspark.sql import functions as F

from laptrace.llm import interactions


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search("[#$%&*|]", text))}


def brute(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    first, rows, out = {}, [], []
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, text, lang in docs:
        bad = {k for k, v in fails(text or "").items() if v}
        if i is not None and first[text or ""] < i:
            bad.add("E")
        good = i is not None and any(j == i and q == 1 for j, q, _ in labels)
        toxic = i is not None and any(j == i and t == 1 for j, _, t in labels)
        rows.append((lang or "", bad, good, toxic))
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        removed = {}
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                stays = [r for r in left if f not in r[1]]
                failing = [r for r in own if f in r[1]]
                removed[f] = removed.get(f, 0) + len(gone)
                out.append([part, order, step, len(stays), len(gone), len(failing) - len(gone),
                            sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone), f])
                left = stays
        for r in out:
            if r[0] == part:
                r[-1] = removed[r[-1]]
    return sorted(map(tuple, out))


LABELS = [(5, 1, 0), (2, 1, 1), (2, 0, None), (9, None, 1), (21, 1, 1), (None, 1, 1), (10 ** 9, 1, 0), (50, 1, None)]


def test_edge_rows(spark, edge_docs, edge):
    docs = [(i, t, lang) for i, t, lang, *_ in edge]
    more = [(100, "A$ B", "en"), (101, "A$ B", "en"), (102, "A$ B", None), (-7, "", ""), (103, None, None)]
    frame = edge_docs.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string"),
                                  allowMissingColumns=True).withColumn("odd.name", F.lit(1))
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("part", F.lit("x"))
    found = interactions.audit(frame, labels)
    assert sorted(map(tuple, found.collect())) == brute(docs + more, LABELS)


def test_more_parts_than_the_row_limit(spark):
    docs = spark.range(40).select("id", F.concat(F.lit("l"), "id").alias("lang"), F.lit("a B").alias("text"))
    before = spark.conf.get(interactions.ROW_LIMIT)
    spark.conf.set(interactions.ROW_LIMIT, "2000")
    try:
        found = interactions.audit(docs.withColumnRenamed("id", "doc_id"),
                                   spark.createDataFrame([], "doc_id long, quality int, toxic int"))
        assert found.count() == 40 * 600 and spark.conf.get(interactions.ROW_LIMIT) == "2000"
    finally:
        spark.conf.set(interactions.ROW_LIMIT, before)


def test_empty(spark, no_docs):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert interactions.audit(no_docs, labels).count() == 0
