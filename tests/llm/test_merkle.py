import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from laptrace.llm import merkle

LOW = str.maketrans(merkle.UPPER, merkle.LOWER)
COLUMNS = ["doc_id", "source", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][a:a + 16])) for a in range(0, len(out[-1]), 16)])
    return out


def climb(tree, at, node):
    """Siblings up to the top, and what a leaf folds to with them."""
    proof = ""
    for nodes in tree[:-1]:
        run, own = nodes[at - at % 16: at - at % 16 + 16], at % 16
        proof += "".join(run[:own] + run[own + 1:])
        node = digest("".join(run[:own]) + node + "".join(run[own + 1:]))
        at //= 16
    return proof, node


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text) to the columns above."""
    trees, order = {}, sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    for source in order:
        own = sorted((r for r in rows if r[1] == source), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[source] = own, levels([leaf(r) for r in own])
    top = levels([trees[s][1][-1][0] for s in order])
    out = []
    for k, source in enumerate(order):
        own, tree = trees[source]
        for at, r in enumerate(own):
            changed = r
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                changed = (*r[:4], r[4].translate(LOW))
            low, node = climb(tree, at, leaf(changed))
            high, node = climb(top, k, node)
            out.append((r[0], source, leaf(r), tree[-1][0], top[-1][0], digest(low + high), node, node == top[-1][0]))
    return sorted(out, key=repr)


def manifest(docs, levels=merkle.LEVELS):
    return merkle.Manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 5 == 0, merkle.lower_cased(F.col("text")),
                           levels)


def test_edge_rows(spark, edge_docs, edge):
    rows = [(i, s, lang, n, t) for i, t, lang, s, n in edge]
    found = manifest(edge_docs.withColumn("odd.name", F.lit(1))).rows().select(*COLUMNS).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_many_blocks(spark, depth):
    """Trees of 1 to 4369 leaves and more than 256 sources, in blocks of one, two and three levels."""
    sizes = {"a": 4369, "b": 256, None: 257, "c": 16, "é": 17, **{f"s{k}": 1 for k in range(300)}}
    rows, n = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            rows.append((n * 7919 % 20011, source, None, n, f"Text {n % 90}"))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    found = manifest(docs, depth).rows().select(*COLUMNS).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)


def test_versions_share_all_other_nodes(spark):
    rows = [(i, "a" if i < 400 else "b", "en", i, f"Text {i}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    made = manifest(docs, 1)
    versions = {r.doc_id: r for r in made.versions().collect()}
    assert set(versions) == {i for i in range(500) if zlib.crc32(str(i).encode()) % 5 == 0}
    for i, version in versions.items():
        changed = [(*r[:4], r[4].translate(LOW)) if r[0] == i else r for r in rows]
        own = [r for r in changed if r[1] == version.source]
        new, old = levels([leaf(r) for r in own]), levels([leaf(r) for r in rows if r[1] == version.source])
        at = [version.position // 16 ** k for k in range(len(new))]
        assert version.copied[:len(new)] == [nodes[p] for nodes, p in zip(new, at, strict=True)]
        assert all(x == y or p == at[k] for k in range(len(new)) for p, (x, y) in enumerate(zip(new[k], old[k], strict=True)))
    folded = {r.doc_id: r.folded_root for r in made.rows().collect()}
    assert all(folded[i] == v.copied[-1] for i, v in versions.items())


def test_empty(no_docs):
    assert manifest(no_docs).rows().count() == 0 and manifest(no_docs).versions().count() == 0
