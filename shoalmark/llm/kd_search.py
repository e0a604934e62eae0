"""Exact top-k by inner product with a KD-tree per shard.

Trees split at the median of the widest dimension and keep tight bounding boxes. A query
walks best box first by the largest inner product any point of the box could have, and
stops at the k-th score found so far. Shards are the leaves of one more such tree, whose splits
are medians of a bounded sample; every row goes to one, and every shard's box is that of all its
rows. Each query first searches the shard it lives in; the k-th score from there goes with it to
those shards whose boxes can reach it, and to no others.
"""

from __future__ import annotations

import heapq
from bisect import insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoalmark.session import stage

LIMIT = 1 << 62  # larger components are an error
SAMPLE_ROWS = 8192  # the tree of shards is fitted on about so many rows, all of which are indexed
SPLIT_SAMPLE = 16  # least rows of the sample on each side of a split
BOUND_ROWS = 256  # queries whose bounds are in memory at once
FOUND = "query_id long, query_key long, vec_id long, score long, nth int"
BOX = "dims int, box_shard long, low array<long>, high array<long>"
REACHED = "query_id long, query_key long, asked_dims int, asked_shard long, known double"


class Tree:
    """A KD-tree over integer points; ids break ties."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf_size: int):
        low, high, first, last, children = [], [], [], [], []
        order = np.arange(len(points))
        stack = [(0, len(points), -1, 0)]
        while stack:
            a, b, parent, side = stack.pop()
            node, here = len(low), points[order[a:b]]
            if parent >= 0:
                children[parent][side] = node
            low.append(here.min(axis=0))
            high.append(here.max(axis=0))
            first.append(a)
            last.append(b)
            children.append([-1, -1])
            spread = high[-1] - low[-1]
            if b - a <= leaf_size or not spread.any():
                order[a:b] = order[a:b][np.argsort(ids[order[a:b]], kind="stable")]
                continue
            widest = here[:, int(spread.argmax())]
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(widest, middle)]
            stack += [(a, a + middle, node, 0), (a + middle, b, node, 1)]
        self.points, self.ids = points[order], ids[order]
        self.low, self.high = np.array(low), np.array(high)
        self.first, self.last, self.children = first, last, children
        self.least_id = [int(self.ids[a:b].min()) for a, b in zip(first, last)]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and node the largest inner product a point of the box can have."""
        return (np.maximum(queries, 0) @ self.high.T) + (np.minimum(queries, 0) @ self.low.T)

    def search(self, query: np.ndarray, own: int, bounds: np.ndarray, k: int,
               known: float) -> list[tuple[int, int]]:
        """(-score, id) of the best ``k`` points with a score of ``known`` or more, in order."""
        best: list[tuple[int, int]] = []
        heap = [(-bounds[0], self.least_id[0], 0)]
        while heap:
            bound, least, node = heapq.heappop(heap)
            if -bound < known:
                break
            if len(best) == k and (bound, least) > best[-1]:
                continue
            left, right = self.children[node]
            if left >= 0:
                for child in (left, right):
                    heapq.heappush(heap, (-bounds[child], self.least_id[child], child))
                continue
            a, b = self.first[node], self.last[node]
            scores = self.points[a:b] @ query
            ids = self.ids[a:b]
            good = np.flatnonzero((scores >= known) & (ids != own))
            if len(good) > k:
                good = good[np.lexsort((ids[good], -scores[good]))[:k]]
            for i in good:
                insort(best, (-int(scores[i]), int(ids[i])))
            del best[k:]
            if len(best) == k:
                known = max(known, -best[-1][0])
        return best


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.int64).reshape(len(vectors), -1)


def _exact(points: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vectors as doubles if their inner products stay exact, which is much faster."""
    most = (max(int(np.abs(points).max(initial=0)), 1) * max(int(np.abs(asked).max(initial=0)), 1)
            * max(points.shape[1], 1))
    if most >= 2**63:
        raise OverflowError(f"inner products of up to {most} do not fit 64 bits")
    return (points.astype(np.float64), asked.astype(np.float64)) if most < 2**53 else (points, asked)


def _search_shard(k: int, leaf_size: int):
    def run(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {name.split()[0]: [] for name in FOUND.split(", ")}
        if len(points) and len(queries):
            vectors, asked = _exact(_matrix(points["vector"]), _matrix(queries["asked"]))
            tree = Tree(vectors, points["vec_id"].to_numpy(), leaf_size)
            bounds = tree.bounds(asked)
            for i, (own, key, known) in enumerate(zip(
                    queries["query_id"], queries["query_key"], queries["known"])):
                known = -np.inf if pd.isna(known) else known
                for nth, (score, vec_id) in enumerate(
                        tree.search(asked[i], own, bounds[i], k, known), 1):
                    for name, value in zip(out, (own, key, vec_id, -score, nth)):
                        out[name].append(value)
        return pd.DataFrame(out).astype({"nth": "int32"})

    return run


def _reached(boxes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """The queries, with each shard but their own whose box can reach the score they know."""
    out = []
    if len(boxes) and len(queries):
        low, high = _matrix(boxes["low"]), _matrix(boxes["high"])
        both, asked = _exact(np.concatenate([low, high]), _matrix(queries["asked"]))
        low, high = both[:len(low)], both[len(low):]
        shard, home = boxes["box_shard"].to_numpy(), queries["home"].to_numpy()
        known = queries["known"].fillna(-np.inf).to_numpy()
        for at in range(0, len(asked), BOUND_ROWS):
            some = slice(at, at + BOUND_ROWS)
            most = np.maximum(asked[some], 0) @ high.T + np.minimum(asked[some], 0) @ low.T
            here, there = np.nonzero((most >= known[some, None]) & (shard[None, :] != home[some, None]))
            out.append(pd.DataFrame({
                "query_id": queries["query_id"].to_numpy()[here + at], "query_key": queries["query_key"].to_numpy()[here + at],
                "asked_dims": queries["asked_dims"].to_numpy()[here + at], "asked_shard": shard[there],
                "known": queries["known"].to_numpy()[here + at]}))
    return pd.concat(out) if out else pd.DataFrame({name.split()[0]: [] for name in REACHED.split(", ")})


def shard_splits(sample: np.ndarray, leaves: int) -> list[tuple[int, int, int, int]]:
    """A tree of median splits with up to ``leaves`` leaves: (dimension, value, below, above) for
    each node, where a negative child -1 - i is leaf i. Values below go left."""
    splits: list[list[int]] = []
    waiting, made = [(sample, leaves, -1, 0)], 0  # points, their share of the leaves, parent and side
    while waiting:
        points, share, parent, side = waiting.pop()
        spread = points.max(axis=0) - points.min(axis=0)
        if share <= 1 or len(points) < 2 * SPLIT_SAMPLE or not spread.any():
            here, made = -1 - made, made + 1
        else:
            widest = int(spread.argmax())
            values = np.sort(points[:, widest])
            middle = int(values[len(values) // 2])
            if middle == values[0]:  # so that neither side is empty
                middle = int(values[np.searchsorted(values, middle, side="right")])
            here = len(splits)
            splits.append([widest, middle, 0, 0])
            below = points[:, widest] < middle
            waiting += [(points[below], share // 2, here, 2), (points[~below], share - share // 2, here, 3)]
        if parent >= 0:
            splits[parent][side] = here
    return [tuple(split) for split in splits]


def leaf_numbers(vectors: np.ndarray, splits: list[tuple[int, int, int, int]]) -> np.ndarray:
    """The leaf that each vector falls into."""
    if not splits:
        return np.zeros(len(vectors), dtype=np.int32)
    table = np.array(splits, dtype=np.int64)
    at = np.zeros(len(vectors), dtype=np.int64)
    while (walking := np.flatnonzero(at >= 0)).size:
        dimension, value, below, above = table[at[walking]].T
        at[walking] = np.where(vectors[walking, dimension] < value, below, above)
    return (-1 - at).astype(np.int32)


def integer_vectors(embeddings: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, vector): floor(scale * component). Vectors that are null or hold a null or a
    non-finite component take no part; a component of 2**62 or more at this scale is an error."""
    x = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    fit = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = lambda v: F.when(F.abs(v * scale) < float(LIMIT), F.floor(v * scale)).otherwise(
        F.raise_error(F.concat(F.lit("component too large: "), v.cast("string"))).cast("long"))
    return x.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fit).select(
        "vec_id", F.transform("embedding", whole).alias("vector"))


def in_shards(vectors: DataFrame, n: int, shard_rows: int) -> DataFrame:
    """Add ``shard``: the leaf of the sample's tree, and where a leaf has more than
    ``shard_rows`` rows a part of it by hash.

    There is a tree for each number of dimensions that the sample has; its rows are chosen by
    hash, about SAMPLE_ROWS of them.
    """
    every = max(1, n // SAMPLE_ROWS)
    sample = vectors.where(F.pmod(F.xxhash64("vec_id", "vector_key"), F.lit(every)) == 0).select("dims", "vector").toArrow()
    shapes, held = sample["dims"].to_numpy(), sample["vector"].combine_chunks()
    trees = {}
    for dims in np.unique(shapes[shapes > 0]).tolist():
        some = np.flatnonzero(shapes == dims)
        rows = held.take(pa.array(some)).flatten().to_numpy().reshape(len(some), dims)
        trees[dims] = shard_splits(rows, -(-n // shard_rows))

    def leaves(batches):
        for batch in batches:
            dims = batch["dims"].to_numpy()
            leaf = np.zeros(len(dims), dtype=np.int32)
            for shape in np.unique(dims):
                some = np.flatnonzero(dims == shape)
                if trees.get(int(shape)):
                    flat = batch["vector"].take(pa.array(some)).flatten().to_numpy()
                    leaf[some] = leaf_numbers(flat.reshape(len(some), -1), trees[int(shape)])
            yield batch.append_column("leaf", pa.array(leaf))

    placed = stage(vectors.mapInArrow(leaves, "vec_id long, vector array<long>, vector_key long, dims int, copies long, leaf int"),
                   "leaves")
    sizes = placed.groupBy("dims", "leaf").agg(F.count(F.lit(1)).alias("n"))
    parts = sizes.select("dims", "leaf", F.ceil(F.col("n") / shard_rows).alias("parts"))
    shard = F.col("leaf").cast("long") * F.lit(1 << 32) + F.pmod(F.xxhash64("vec_id", "vector_key"), "parts")
    return stage(placed.join(parts, ["dims", "leaf"]).withColumn("shard", shard).drop("leaf", "parts"), "shards")


def boxes_of(points: DataFrame) -> DataFrame:
    """(dims, box_shard, low, high): the extremes of every shard in every dimension."""
    schema = pa.schema([("dims", pa.int32()), ("box_shard", pa.int64()), ("low", pa.list_(pa.int64())),
                        ("high", pa.list_(pa.int64()))])

    def box(batches):
        for batch in batches:
            dims, shard = batch["dims"].to_numpy(), batch["shard"].to_numpy()
            for shape in np.unique(dims):
                some = np.flatnonzero(dims == shape)
                some = some[np.argsort(shard[some], kind="stable")]
                vectors = batch["vector"].take(pa.array(some)).flatten().to_numpy().reshape(len(some), shape)
                numbers = shard[some]
                starts = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))
                low, high = (f.reduceat(vectors, starts, axis=0).tolist() for f in (np.minimum, np.maximum))
                yield pa.RecordBatch.from_pydict(
                    {"dims": [int(shape)] * len(starts), "box_shard": numbers[starts], "low": low, "high": high}, schema=schema)

    def extremes(pieces: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"dims": pieces["dims"][:1], "box_shard": pieces["box_shard"][:1],
                             "low": [_matrix(pieces["low"]).min(axis=0)], "high": [_matrix(pieces["high"]).max(axis=0)]})

    # Pieces of boxes first, one for each shard in a batch, so that few vectors are shuffled.
    pieces = points.select("dims", "shard", "vector").mapInArrow(box, BOX)
    return stage(pieces.groupBy("dims", "box_shard").applyInPandas(extremes, BOX), "boxes")


def reached_shards(queries: DataFrame, boxes: DataFrame, n_queries: int, block_rows: int) -> DataFrame:
    """(REACHED) for each query the shards besides its own whose boxes reach the score it knows.

    Queries meet boxes in blocks of about ``block_rows`` of each.
    """
    few = max(1, -(-n_queries // block_rows))
    many = max(1, -(-boxes.count() // block_rows))
    left = boxes.withColumn("box_block", F.pmod(F.xxhash64("box_shard"), F.lit(many))).withColumn(
        "query_block", F.explode(F.sequence(F.lit(0), F.lit(few - 1))))
    right = queries.withColumn("asked_block", F.pmod(F.xxhash64("query_key", "query_id"), F.lit(few)).cast("int")).withColumn(
        "for_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many - 1).cast("long"))))
    return stage(left.groupBy("dims", "box_block", "query_block").cogroup(
        right.groupBy("asked_dims", "for_block", "asked_block")).applyInPandas(_reached, REACHED), "reached")


def top_k(vectors: DataFrame, k: int = 10, query_every: int = 100, shard_rows: int = 8192,
          query_rows: int = 4096, leaf_size: int = 32) -> DataFrame:
    """The ``k`` highest inner products of each query: query_id, rank, vec_id, score.

    Queries are the rows whose vec_id is divisible by ``query_every``; candidates are all
    rows of the same dimension but those with the query's own id; ties go to the smaller
    vec_id. Fewer candidates than ``k`` give fewer rows, none give none, as does an empty
    table. Rows repeated whole are candidates of their own, each with its rank; rows that share
    a query's id are one query, ranked together. Exact as long as the inner products of a shard are
    sure to fit 64 bits, that is dims * (largest component)**2 < 2**63; beyond that it raises.

    A shard has about ``shard_rows`` points and meets queries in blocks of about
    ``query_rows``, so no task holds more than one shard and one block.
    """
    vectors = stage(
        vectors.select("vec_id", "vector", F.xxhash64("vector").alias("vector_key"), F.size("vector").alias("dims"))
        .groupBy("vec_id", "vector_key").agg(
            F.first("vector").alias("vector"), F.first("dims").alias("dims"), F.count(F.lit(1)).alias("copies"))
        .select("vec_id", "vector", "vector_key", "dims", "copies"), "vectors")
    is_query = F.col("vec_id") % query_every == 0
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).first()
    placed = in_shards(vectors, size.n, shard_rows)
    # Of equal rows only the first k can be among the k best.
    points = placed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int")))).drop(
        "copy", "copies")
    # Names of its own, as both sides of the search come from one table.
    queries = placed.where(is_query).select(
        F.col("vec_id").alias("query_id"), F.col("vector_key").alias("query_key"), F.col("vector").alias("asked"),
        F.col("dims").alias("asked_dims"), F.col("shard").alias("home"), F.col("copies").alias("times"))
    by = ("dims", "shard", "block")

    def search(asked: DataFrame) -> DataFrame:
        """Blocks of a shard's own queries, for each of which the shard's points are there once."""
        counts = asked.groupBy("asked_dims", "asked_shard").agg(F.count(F.lit(1)).alias("q"))
        blocks = stage(counts.select("asked_dims", "asked_shard", F.ceil(F.col("q") / query_rows).cast("int").alias("blocks")),
                       "query-blocks")
        block = F.pmod(F.xxhash64("query_key", "query_id"), "blocks").cast("int")
        left = points.join(blocks.withColumnsRenamed(
            {"asked_dims": "dims", "asked_shard": "shard", "blocks": "times"}), ["dims", "shard"]).withColumn(
            "block", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
        right = asked.join(blocks, ["asked_dims", "asked_shard"]).withColumn("asked_block", block)
        return left.groupBy(*by).cogroup(right.groupBy(*(f"asked_{c}" for c in by))).applyInPandas(
            _search_shard(k, leaf_size), FOUND)

    at_home = stage(search(queries.withColumn("asked_shard", F.col("home"))
                           .withColumn("known", F.lit(None).cast("double"))), "home")
    at_most = F.col("score").cast("double")  # a double may be above a large score, so a little less
    known = at_home.where(F.col("nth") == k).select(
        "query_id", "query_key", (at_most - F.abs(at_most) * 2.0**-52).alias("known"))
    informed = stage(queries.join(known, ["query_id", "query_key"], "left"), "informed")
    reached = reached_shards(informed, boxes_of(placed), size.q, query_rows)
    elsewhere = reached.join(informed.select("query_id", "query_key", "asked"), ["query_id", "query_key"])
    found = at_home.unionByName(search(elsewhere)).join(
        queries.select("query_id", "query_key", "times"), ["query_id", "query_key"])
    best = found.withColumn("nth", F.row_number().over(
        Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id"))).where(F.col("nth") <= k)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    again = F.explode(F.sequence(F.lit(1), F.least("times", F.lit(k)).cast("int")))
    return (best.withColumn("again", again).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
