"""Merkle manifest of a dataset as a persistent tree, built and proved block by block.

Every document is a leaf; the leaves of a language form a tree of fan-out 8 and the languages'
roots a tree above. A tree is cut into aligned blocks, BLOCK_LEVELS levels high.
Round by round a task reduces each block to its top node, until each tree has one block. Then
the way back: every block is handed the path of its top node, from the last round to the leaves.
A tampered leaf is a version of its own: the block's tree stays as it is, only the ancestors of
that leaf are copied, and the copies go on along the path of the block's top to the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoalmark.operators.joins import sized_join
from shoalmark.session import stage

FANOUT = 8  # fixed value
BLOCK_LEVELS = 3  # a block has up to 8**3 nodes
COPIES = 4096  # equal leaves that one row stands for while leaves are put in order
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")  # fixed value
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROWS_AT_ONCE = 512  # handed on by a task
OFFSET_BYTES = 48  # of a row of offsets, without the tree's name

# One sibling pair for each level upwards: digests left and right of the node in its run.
PATH = "array<struct<left string, right string>>"
NODE = "tree string, total long, block long, slot int, digest string, name string, doc_id long, changed string"
HEAD = f"tree string, block long, path {PATH}, subroot string, root string"


def hashed(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- leaves --------------------------------------------------------------------------


def field(value: Column) -> Column:
    """``-`` for null, else the byte count, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 0, F.lit(False))


def leaves(documents: DataFrame) -> DataFrame:
    """(tree, doc_id, digest, changed, n): one row for equal leaves, which are counted. ``changed``
    is the leaf after tampering, null where nothing is tampered with. ``tree`` is the language
    behind a mark, so that null comes first and differs from every name."""
    own = [F.col(name) for name in FIELDS]
    other = [F.translate("text", UPPER, LOWER) if name == "text" else F.col(name) for name in FIELDS]
    rows = documents.select(
        F.coalesce(F.concat(F.lit("1"), F.col("lang").cast("string")), F.lit("0")).alias("tree"),
        F.col("doc_id").cast("long"), leaf(own).alias("digest"),
        F.when(tampered(F.col("doc_id")), leaf(other)).alias("changed"))
    return rows.groupBy("tree", "doc_id", "digest", "changed").agg(F.count(F.lit(1)).alias("n"))


# --- places --------------------------------------------------------------------------


def numbered(rows: DataFrame, order: list[str], levels: int) -> DataFrame:
    """Nodes (NODE) from rows (tree, n, digest, name, doc_id, changed): ``n`` nodes each, placed
    from 0 within their tree by ``order``.

    Rows are sorted by range, so no tree is gathered in one task. Each task counts the nodes of
    a tree before each of its rows; the counts of the tasks before it are added after.
    """
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES}")))
    rows = rows.withColumn("part", part).withColumn("n", F.least(F.lit(COPIES), F.col("n") - F.col("part") * COPIES))
    by = [F.col("tree"), *[F.asc_nulls_first(c) for c in order], F.col("part")]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    schema = T.StructType([*ordered.schema.fields, T.StructField("task", T.IntegerType()),
                           T.StructField("before", T.LongType())])
    counted = stage(ordered.mapInArrow(_count(to_arrow_schema(schema)), schema), "merkle-order")
    here = counted.groupBy("tree", "task").agg(F.sum("n").alias("here"), F.count(F.lit(1)).alias("rows"))
    upto = F.sum("here").over(Window.partitionBy("tree").orderBy("task"))
    offsets = stage(here.select(
        "tree", "task", "rows", (upto - F.col("here")).alias("earlier"),
        F.sum("here").over(Window.partitionBy("tree")).alias("total")), "merkle-offsets")
    size = offsets.agg(F.sum(F.octet_length("tree") + OFFSET_BYTES)).first()[0] or 0
    placed = sized_join(counted, offsets.drop("rows"), ["tree", "task"], size,
                        counted=offsets.select("tree", "task", F.col("rows").alias("n")))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))
    placed = placed.withColumn("copy", copy).withColumn("place", F.col("earlier") + F.col("before") + F.col("copy"))
    return nodes(placed, levels)


def nodes(placed: DataFrame, levels: int) -> DataFrame:
    return placed.select(
        "tree", "total", F.expr(f"place div {FANOUT ** levels}").alias("block"),
        (F.col("place") % FANOUT ** levels).cast("int").alias("slot"), "digest", "name", "doc_id", "changed")


def _count(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        tree, total = None, 0
        for batch in batches:
            before = []
            for name, n in zip(batch["tree"].to_pylist(), batch["n"].to_pylist()):
                if name != tree:
                    tree, total = name, 0
                before.append(total)
                total += n
            columns = [*batch.columns, pa.array([task] * len(before), pa.int32()), pa.array(before, pa.int64())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


# --- the tree of a block -------------------------------------------------------------


class BlockTree:
    """The levels of one block, never changed once built; a version has its own copies of the
    ancestors of one leaf and shares all other nodes with the tree."""

    def __init__(self, digests: list[str], total: int, levels: int) -> None:
        self.levels = [digests]
        while len(self.levels[-1]) > 1 if total <= FANOUT ** levels else len(self.levels) <= levels:
            below = self.levels[-1]
            self.levels.append([hashed("".join(below[i:i + FANOUT])) for i in range(0, len(below), FANOUT)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def path(self, slot: int) -> list[tuple[str, str]]:
        """Left and right siblings of a leaf and of its ancestors, up to below the top."""
        pairs = []
        for level in self.levels[:-1]:
            run = slot - slot % FANOUT
            pairs.append(("".join(level[run:slot]), "".join(level[slot + 1:run + FANOUT])))
            slot //= FANOUT
        return pairs


def version(digest: str, path: list[tuple[str, str]]) -> list[str]:
    """Copies of the ancestors along ``path`` for another digest at its foot, the root last."""
    copies = []
    for left, right in path:
        digest = hashed(left + digest + right)
        copies.append(digest)
    return copies


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one block after the other, from rows sorted by tree, block and slot."""
    run: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if run and (row["tree"], row["block"]) != (run[0]["tree"], run[0]["block"]):
                yield run
                run = []
            run.append(row)
    if run:
        yield run


def by_block(rows: DataFrame, each: Callable[[list[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """Apply ``each`` to the rows of every block, of which a task holds one at a time."""
    target = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []
        for block in blocks(batches):
            waiting += each(block)
            if len(waiting) >= ROWS_AT_ONCE:
                yield pa.RecordBatch.from_pylist(waiting, schema=target)
                waiting = []
        if waiting:
            yield pa.RecordBatch.from_pylist(waiting, schema=target)

    gathered = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "slot")
    return gathered.mapInArrow(run, schema)


# --- rounds upwards ------------------------------------------------------------------


@dataclass
class Forest:
    """Trees over ``rounds`` of nodes; each round's blocks, and those that end their tree."""

    levels: int  # of a block
    rounds: list[DataFrame]
    ended: list[DataFrame]  # (tree, digest) of the trees that end in the round

    @property
    def roots(self) -> DataFrame:
        roots = self.ended[0]
        for more in self.ended[1:]:
            roots = roots.unionByName(more)
        return roots


def _top(levels: int, block: list[dict]) -> Iterator[dict]:
    first = block[0]
    yield {"tree": first["tree"], "total": first["total"], "block": first["block"],
           "digest": BlockTree([row["digest"] for row in block], first["total"], levels).top}


def build(first_round: DataFrame, levels: int) -> Forest:
    """Reduce blocks to their top nodes, round by round, until each tree has one. A round has one
    node for each block of the round before."""
    forest, size = Forest(levels, [], []), FANOUT ** levels
    here = first_round
    while True:
        tops = stage(by_block(here.select("tree", "total", "block", "slot", "digest"), partial(_top, levels),
                              "tree string, total long, block long, digest string"), "merkle-tops")
        forest.rounds.append(here)
        forest.ended.append(tops.where(F.col("total") <= size).select("tree", "digest"))
        rest = tops.where(F.col("total") > size)
        if rest.isEmpty():
            return forest
        none = [F.lit(None).cast("string").alias("name"), F.lit(None).cast("long").alias("doc_id"),
                F.lit(None).cast("string").alias("changed")]
        here = nodes(rest.withColumnRenamed("block", "place").withColumn(
            "total", F.expr(f"(total + {size - 1}) div {size}")).select("tree", "total", "place", "digest", *none), levels)


# --- and back ------------------------------------------------------------------------


def _pairs(path: list[dict]) -> list[tuple[str, str]]:
    return [(step["left"], step["right"]) for step in path]


def _paths(levels: int, block: list[dict]) -> Iterator[dict]:
    """The whole path of each node of a block; the block's first row is its head. Only the leaves
    of the upper tree have a name, that of the language whose root they are."""
    head, rows = block[0], block[1:]
    tree = BlockTree([row["digest"] for row in rows], rows[0]["total"], levels)
    above = _pairs(head["path"])
    for row in rows:
        path = tree.path(row["slot"]) + above
        yield {"tree": row["tree"], "block": row["block"] * FANOUT ** levels + row["slot"], "name": row["name"],
               "path": [{"left": a, "right": b} for a, b in path],
               "subroot": row["digest"] if row["name"] is not None else head["subroot"], "root": head["root"]}


def _proofs(levels: int, block: list[dict]) -> Iterator[dict]:
    """Each leaf's proof, and the root of the version in which only this leaf is tampered with."""
    head, rows = block[0], block[1:]
    tree = BlockTree([row["digest"] for row in rows], rows[0]["total"], levels)
    above = _pairs(head["path"])
    for row in rows:
        path = tree.path(row["slot"]) + above
        start = row["changed"] or row["digest"]
        copies = version(start, path)
        folded = copies[-1] if copies else start
        yield {"doc_id": row["doc_id"], "leaf": row["digest"], "subroot": head["subroot"], "root": head["root"],
               "proof_sha256": hashed("".join(left + right for left, right in path)),
               "folded_root": folded, "verified": folded == head["root"],
               "copies": copies if row["changed"] else []}


def hand_down(forest: Forest, heads: DataFrame, each: Callable, schema: str) -> DataFrame:
    """``each`` over the blocks of leaves, each behind a head row with the path of its top.

    ``heads`` (HEAD without block) has the path of each tree's root. A head joins its block as
    one row of the same shuffle, so paths are not repeated for every leaf.
    """
    lower = None
    for number in range(len(forest.rounds) - 1, -1, -1):
        ends = forest.ended[number].select("tree").join(heads, "tree").withColumn("block", F.lit(0).cast("long"))
        above = ends if lower is None else ends.unionByName(lower)
        rows = forest.rounds[number].unionByName(above.withColumn("slot", F.lit(-1)), allowMissingColumns=True)
        if number == 0:
            return by_block(rows, partial(each, forest.levels), schema)
        lower = stage(by_block(rows, partial(_paths, forest.levels), f"{HEAD}, name string"), "merkle-paths").drop("name")


def manifest(documents: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, and
    copies, the nodes of the version in which its leaf is tampered with (its copied ancestors from
    below to the root; empty where nothing is tampered with).

    Nulls in any column are hashed as ``-``; null languages form a tree of their own, the first,
    and null ids come first in their tree and are not tampered with. Documents with one id are
    ordered by leaf, and rows repeated whole are leaves of their own beside each other. An empty
    table gives no rows. Other columns are not read. Texts are hashed where they are read, so
    their length does not matter after that; from then on rows are two digests and an id.
    """
    none = F.lit(None)
    first = numbered(leaves(documents).withColumn("name", none.cast("string")), ["doc_id", "digest", "changed"], block_levels)
    languages = build(first, block_levels)
    subroots = stage(languages.roots, "merkle-subroots")
    upper = build(stage(numbered(subroots.select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), "digest", none.cast("long").alias("doc_id"),
        none.cast("string").alias("changed"), F.lit(1).cast("long").alias("n")), ["name"], block_levels), "merkle-upper"), block_levels)
    summit = upper.roots.select(
        "tree", F.array().cast(PATH).alias("path"), none.cast("string").alias("subroot"), F.col("digest").alias("root"))
    heads = stage(hand_down(upper, summit, _paths, f"{HEAD}, name string"), "merkle-heads")
    return hand_down(languages, heads.select(F.col("name").alias("tree"), "path", "subroot", "root"), _proofs,
                     "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                     "folded_root string, verified boolean, copies array<string>")
