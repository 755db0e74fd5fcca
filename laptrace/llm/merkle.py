"""Merkle manifest of a table: one tree per source, one tree over the sources, proofs and versions.

Trees are persistent.  A changed leaf makes a version that copies the ancestors of that leaf and shares
every other node with the tree it came from, so a version is its copied nodes only.  Nodes are dealt to
aligned blocks of three levels of runs of 16, 4096 nodes; inside a block the tree is built, proved and copied
in one task, the tops of blocks are the nodes of the next round, and versions go on along its paths.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laptrace.llm.tables import stored

RUN = 16
#: Levels of a block.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: One level of a path: the digests before and behind the node in its run.
STEP = "struct<before:string,behind:string>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def node_hash(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf(changed: dict[str, Column] | None = None) -> Column:
    """Digest of a row: every field as its UTF-8 byte count, a colon and its value, '-' where it is null."""
    def part(name: str) -> Column:
        value = (changed or {}).get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(part, FIELDS)), 256)


def lower_cased(text: Column) -> Column:
    """Tampering of the registered query: A-Z become a-z, nulls stay."""
    return F.translate(text, UPPER, LOWER)


class Tree:
    """A block of a persistent tree: ``levels[0]`` are its nodes, each further level the runs of the one below."""

    def __init__(self, nodes: list[str], n: int, levels: int):
        """A block that is a whole tree of ``n`` nodes ends at its root, others have ``levels`` levels more."""
        self.levels = [nodes]
        while len(self.levels[-1]) > 1 if n <= RUN ** levels else len(self.levels) <= levels:
            below = self.levels[-1]
            self.levels.append([node_hash(*below[a: a + RUN]) for a in range(0, len(below), RUN)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def path(self, at: int) -> list[tuple[str, str]]:
        """For each level up to the top: the siblings before and behind the node's ancestor."""
        out = []
        for nodes in self.levels[:-1]:
            first = at - at % RUN
            out.append(("".join(nodes[first:at]), "".join(nodes[at + 1: first + RUN])))
            at //= RUN
        return out


def copied(node: str, path: list[tuple[str, str]]) -> list[str]:
    """The ancestors a version copies when a node becomes ``node``, upwards; all else stays shared."""
    out = []
    for before, behind in path:
        node = node_hash(before, node, behind)
        out.append(node)
    return out


def _blocks(nodes: DataFrame, key: str, levels: int, *carry: str) -> DataFrame:
    """(key, block, n, items): nodes (key, pos, n, node, carry) in aligned blocks, in order.

    ``n`` is the number of nodes of the whole tree.  A block holds at most ``16 ** levels`` items.
    """
    return nodes.groupBy(key, F.floor(F.col("pos") / RUN ** levels).alias("block"), "n").agg(
        F.sort_array(F.collect_list(F.struct("pos", "node", *carry))).alias("items"))


def _blocks_of(n: str, levels: int) -> Column:
    return F.ceil(F.col(n) / RUN ** levels)


def _tops(key: str, levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = [Tree(nodes, n, levels).top for n, nodes in zip(batch["n"].to_pylist(), _nodes(batch), strict=True)]
            yield pa.RecordBatch.from_arrays([batch[key], batch["block"], batch["n"], pa.array(tops, pa.string())],
                                             names=[key, "block", "n", "top"])
    return run


def _nodes(batch: pa.RecordBatch) -> Iterator[list[str]]:
    for items in batch["items"]:
        yield items.values.field("node").to_pylist() if items.is_valid else []


def _paths(key: str, levels: int):
    """The path of every node of a block: inside the block, then that of the block itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1)
                nodes, above = next(_nodes(row)), _steps(row["above"][0])
                tree = Tree(nodes, row["n"][0].as_py(), levels)
                paths = [[{"before": x, "behind": y} for x, y in tree.path(i) + above] for i in range(len(nodes))]
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([row[key]] * len(nodes)), row["items"][0].values.field("pos"),
                     pa.array(paths, pa.list_(pa.struct([("before", pa.string()), ("behind", pa.string())]))),
                     pa.array([row["root"][0].as_py()] * len(nodes), pa.string())], names=[key, "pos", "path", "root"])
    return run


def _steps(value: pa.Scalar) -> list[tuple[str, str]]:
    return [(s["before"], s["behind"]) for s in value.as_py() or []]


def _tops_as_nodes(blocks: DataFrame, key: str, key_type: str, levels: int) -> DataFrame:
    tops = blocks.mapInArrow(_tops(key, levels), f"{key} {key_type}, block long, n long, top string")
    return tops.select(key, F.col("block").alias("pos"), _blocks_of("n", levels).alias("n"), F.col("top").alias("node"))


def tree_paths(nodes: DataFrame, key: str, key_type: str, levels: int = LEVELS) -> DataFrame:
    """(key, pos, path, root) for nodes (key, pos, n, node) of one or more trees.

    Tops of blocks are the nodes of the next round until no tree has more than one block.
    """
    blocks = stored(_blocks(nodes, key, levels), "blocks")
    most = blocks.agg(F.max("n")).first()[0] or 0
    tops = _tops_as_nodes(blocks, key, key_type, levels)
    if most > RUN ** levels:
        upper = tree_paths(tops, key, key_type, levels)
        placed = blocks.join(upper.select(F.col(key).alias("key_"), F.col("pos").alias("block_"),
                                          F.col("path").alias("above"), "root"),
                             F.col(key).eqNullSafe(F.col("key_")) & (F.col("block") == F.col("block_")))
    else:
        placed = blocks.join(tops.select(F.col(key).alias("key_"), F.col("node").alias("root")),
                             F.col(key).eqNullSafe(F.col("key_"))).withColumn("above", F.lit(None).cast(f"array<{STEP}>"))
    return placed.select(key, "n", "items", "above", "root").mapInArrow(
        _paths(key, levels), f"{key} {key_type}, pos long, path array<{STEP}>, root string")


def positions(leaves: DataFrame, key: str, *order: str) -> DataFrame:
    """Adds ``pos``, from 0 in the given order inside each key, and ``n``, the rows of the key.

    Rows are dealt by range and stored; a key that spans ranges starts in each behind the rows it has in the
    ranges before, so no task sees a whole key.  ``order`` must tell all rows apart.
    """
    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = [F.col(c).asc_nulls_first() for c in (key, *order)]
    ranged = stored(leaves.repartitionByRange(parts, *sort).withColumn("range_", F.spark_partition_id()), "ranges")
    # one row for each range and key
    counts = ranged.groupBy("range_", key).agg(F.count("*").alias("rows_"))
    ahead = Window.partitionBy(key).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("range_").alias("r_"), F.col(key).alias("k_"),
                            F.coalesce(F.sum("rows_").over(ahead), F.lit(0)).alias("ahead_"),
                            F.sum("rows_").over(Window.partitionBy(key)).alias("n"))
    inside = F.row_number().over(Window.partitionBy("range_", key).orderBy(*sort[1:]))
    return (ranged.withColumn("inside_", inside)
            .join(offsets, (F.col("range_") == F.col("r_")) & F.col(key).eqNullSafe(F.col("k_")))
            .withColumn("pos", F.col("ahead_") + F.col("inside_") - 1).drop("range_", "r_", "k_", "inside_", "ahead_"))


class Manifest:
    """A table's Merkle trees, stored in the shared folder: ``blocks`` of leaves and the ``above`` paths of blocks."""

    def __init__(self, docs: DataFrame, tampered: Column, text: Column, levels: int = LEVELS):
        """``tampered`` says which rows a version is made for, ``text`` is the text they have in it.

        Leaves ascend by doc_id in a source, a null id first; rows that share an id ascend by digest, and equal rows
        are leaves of their own, in any order.  A null source is a tree of its own, the first.  Only the five
        fields are read.  An empty table has no trees.
        """
        changed = F.when(F.coalesce(tampered, F.lit(False)), leaf({"text": text}))
        leaves = stored(docs.select(
            F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
            leaf().alias("node"), changed.alias("version"), F.monotonically_increasing_id().alias("row_")), "leaves")
        placed = positions(leaves, "source", "doc_id", "node", "row_").drop("row_")
        self.levels = levels
        self.blocks = stored(_blocks(placed, "source", levels, "doc_id", "version"), "leaf-blocks")
        upper = tree_paths(_tops_as_nodes(self.blocks, "source", "string", levels), "source", "string", levels)
        upper = stored(upper.withColumnRenamed("root", "subroot"), "upper")
        # the sources' roots are the leaves of the last tree
        roots = upper.filter("pos = 0").select(F.lit(0).alias("tree"), "source", F.col("subroot").alias("node"))
        over = positions(roots, "tree", "source")
        last = tree_paths(over.select("tree", "pos", "n", "node"), "tree", "int", levels)
        last = over.select("source", "pos").join(last, "pos").select(
            F.col("source").alias("source_"), F.col("path").alias("last"), "root")
        self.above = stored(upper.join(last, F.col("source").eqNullSafe(F.col("source_"))).select(
            "source", F.col("pos").alias("block"), F.concat("path", "last").alias("above"), "subroot", "root"), "above")

    def _with_above(self) -> DataFrame:
        above = self.above.withColumnsRenamed({"source": "source_", "block": "block_"})
        return self.blocks.join(above, F.col("source").eqNullSafe(F.col("source_")) & (F.col("block") == F.col("block_")))

    def rows(self) -> DataFrame:
        """doc_id, source, position, leaf, subroot, root, proof_sha256, folded_root, verified for each row.

        ``folded_root`` is the root of the row's version where it was tampered with, else what its leaf folds to.
        """
        return self._with_above().select("n", "source", "items", "above", "subroot", "root").mapInArrow(
            _proved(self.levels), "doc_id long, source string, position long, leaf string, subroot string, root string, "
                     "proof_sha256 string, folded_root string, verified boolean")

    def versions(self) -> DataFrame:
        """doc_id, source, position, copied: the version of each tampered row, as the nodes it does not share.

        ``copied`` is the new leaf and the new digest of each ancestor up to the root of all: entry k stands for
        node ``position // 16 ** k`` of level k of the source's tree, the entries behind that tree's root for the
        tree over the sources.  All other nodes are those of the untampered trees.
        """
        return self._with_above().select("n", "source", "items", "above").mapInArrow(
            _copied_rows(self.levels), "doc_id long, source string, position long, copied array<string>")


def _folded(row: pa.RecordBatch, levels: int):
    """(item, path inside the block, path above it) for every leaf of a block."""
    items = row["items"][0].as_py()
    tree = Tree([i["node"] for i in items], row["n"][0].as_py(), levels)
    above = _steps(row["above"][0])
    for at, item in enumerate(items):
        yield item, tree.path(at), above


def _record_batch(rows: list[tuple], **kinds: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))


def _proved(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row, out, over = batch.slice(r, 1), [], None
                source, subroot, root = (row[c][0].as_py() for c in ("source", "subroot", "root"))
                for item, path, above in _folded(row, levels):
                    over = "".join(x + y for x, y in above) if over is None else over
                    proof = node_hash(*(x + y for x, y in path), over)
                    shown = item["version"] or item["node"]
                    folded = [shown, *copied(shown, path + above)][-1]
                    out.append((item["doc_id"], source, item["pos"], item["node"], subroot, root, proof, folded,
                                folded == root))
                text = pa.string()
                yield _record_batch(out, doc_id=pa.int64(), source=text, position=pa.int64(), leaf=text, subroot=text,
                                    root=text, proof_sha256=text, folded_root=text, verified=pa.bool_())
    return run


def _copied_rows(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1)
                source = row["source"][0].as_py()
                yield _record_batch(
                    [(i["doc_id"], source, i["pos"], [i["version"], *copied(i["version"], path + above)])
                     for i, path, above in _folded(row, levels) if i["version"] is not None],
                    doc_id=pa.int64(), source=pa.string(), position=pa.int64(), copied=pa.list_(pa.string()))
    return run


def manifest_sql(source_levels: int = 7, top_levels: int = 4) -> str:
    """The rows of the registered query over ``documents`` for DuckDB.

    Every level is a table of runs; trees of 16 ** 7 leaves a source and 16 ** 4 sources are as high as it goes.
    """
    def row_hash(text: str) -> str:
        values = [text if f == "text" else f"{f}::varchar" for f in FIELDS]
        return "sha256(" + " || ".join(f"coalesce(strlen({v})::varchar || ':' || {v}, '-')" for v in values) + ")"

    def runs(tree: str, key: str, levels: int) -> list[str]:
        out = []
        for k in range(levels):
            out.append(f"""{tree}_runs{k} as (
    select {key}, pos // 16 as run, n, list(node order by pos) as nodes from {tree}{k} group by {key}, pos // 16, n
), {tree}{k + 1} as (
    select {key}, run as pos, (n + 15) // 16 as n,
           case when n > 1 then sha256(array_to_string(nodes, '')) else nodes[1] end as node from {tree}_runs{k}
)""")
        return out

    def climb(start: str, tree: str, key: str, levels: int) -> list[str]:
        """Every leaf's siblings and folded digest, one level more in each table."""
        out, last = [], start
        for k in range(levels):
            own = f"(p.pos // {16 ** k}) % 16"
            out.append(f"""{tree}_up{k + 1} as (
    select p.* exclude (proof, folded),
           p.proof || case when r.n > 1 then array_to_string(r.nodes[1:{own}] || r.nodes[{own} + 2:], '') else '' end as proof,
           case when r.n > 1 then sha256(array_to_string(r.nodes[1:{own}], '') || p.folded
                                         || array_to_string(r.nodes[{own} + 2:], '')) else p.folded end as folded
    from {last} p join {tree}_runs{k} r on p.{key} is not distinct from r.{key} and r.run = p.pos // {16 ** (k + 1)}
)""")
            last = f"{tree}_up{k + 1}"
        return out

    crc_bit = "lambda x, y: xor(x >> 1, case when x & 1 = 1 then 3988292384 else 0 end)"
    crc = (f"xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), "
           f"lambda c: ascii(c)::bigint)), lambda h, c: list_reduce(list_prepend(xor(h, c), [0::bigint, 0, 0, 0, 0, 0, 0, 0]), "
           f"{crc_bit})), 4294967295)")
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    return ",\n".join([f"""with leaves as (
    select doc_id, source, {row_hash("text")} as leaf,
           case when {crc} % 5 = 0 then {row_hash(lowered)} else {row_hash("text")} end as presented
    from documents
), placed as (
    select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos,
           count(*) over (partition by source) as n from leaves
), s0 as (select source, pos, n, leaf as node from placed)""",
        *runs("s", "source", source_levels),
        f"""t0 as (
    select 0 as tree, source, row_number() over (order by source nulls first) - 1 as pos, count(*) over () as n, node
    from s{source_levels}
)""", *runs("t", "tree", top_levels),
        "start as (select *, '' as proof, presented as folded from placed)",
        *climb("start", "s", "source", source_levels),
        f"""up as (
    select u.* exclude (pos, n), t.pos, t.n, t.node as subroot, 0 as tree
    from s_up{source_levels} u join t0 t on u.source is not distinct from t.source
)""", *climb("up", "t", "tree", top_levels)]) + f"""
select doc_id, leaf, subroot, r.node as root, sha256(proof) as proof_sha256, folded as folded_root,
       folded = r.node as verified
from t_up{top_levels} cross join (select node from t{top_levels}) r
"""
