"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A sketch takes the few smallest hashes among a document's occurrence-labelled shingles and
keeps them in text order, so it depends on the order of the text, not on its set of shingles
alone. Some sketches take first occurrences only, so that what a text repeats weighs no more
there than in the similarity. Documents that share a sketch meet in a bucket. Buckets do not emit their pairs: all
members are compared with one pivot, and only where that leaves a bucket in several parts are
its members compared across the parts, by small signatures, block by block.

The similarity of two documents is matched / (distinct shingles of both - matched), where
matched is the largest number of shingles that can be aligned, each text being the sequence of
its shingles at their first occurrences. Copies of one word sequence
are put together first and stand in for each other.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoalmark.llm.common import hash_words, in_arrow, left_join_sized, text_key, words
from shoalmark.session import broadcast_budget, stage

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES, FIRST_ONLY = 24, 10  # in all, and of first occurrences
MINIMA = 3
SIGNATURE_BITS = 4096
DEVIATIONS = 6  # by the normal curve a similar pair fails the signature test once in 10**9
BLOCK_ROWS = 2000
SIDE = ("size", "signature")  # what a comparison needs of a document besides its key
ROW_BYTES = 48

PROFILE = ("doc_id long, key long, exact binary, n_shingles int, sketches array<long>, signature binary")

_ODD = np.random.default_rng(20).integers(0, 1 << 63, SKETCHES + 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers: multiply, fold, multiply."""
    x = (x ^ (x >> np.uint64(31))) * _ODD[-1]
    return (x ^ (x >> np.uint64(29))) * _ODD[-2]


def shingle_hashes(tokens: Sequence[bytes], size: int = SHINGLE) -> np.ndarray:
    """A hash per run of ``size`` words; none if there are fewer words."""
    h = np.fromiter(hash_words(tokens), dtype=np.uint64, count=len(tokens))
    if len(h) < size:
        return h[:0]
    out = np.zeros(len(h) - size + 1, dtype=np.uint64)
    for j in range(size):
        out = mixed(out ^ h[j:len(h) - size + 1 + j])
    return out


def occurrences(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that also tell the first, second, ... occurrence of a shingle apart; and the
    shingles at their first occurrences. Both in text order."""
    order = np.argsort(shingles, kind="stable")
    ordered = shingles[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])[:len(ordered)]
    if fresh.all():
        return shingles, shingles
    place = np.arange(len(ordered))
    nth = np.empty(len(ordered), dtype=np.uint64)
    nth[order] = place - np.maximum.accumulate(np.where(fresh, place, 0))
    return np.where(nth > 0, mixed(shingles + nth * _ODD[-3]), shingles), shingles[nth == 0]


def order_sketches(labelled: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """One number for each sketch: its smallest shingles, in text order."""
    out = np.empty(SKETCHES, dtype=np.uint64)
    for j in range(SKETCHES):
        marked = firsts if j < FIRST_ONLY else labelled
        few = min(MINIMA, len(marked))
        values = marked * _ODD[j]
        values ^= values >> np.uint64(32)
        values *= _ODD[-4]
        at = np.sort(np.argpartition(values, few - 1)[:few]) if few < len(marked) else np.arange(few)
        value = j + 1
        for shingle in marked[at].tolist():
            value = (value * 0x9E3779B97F4A7C15 + shingle) & 0xFFFFFFFFFFFFFFFF
        out[j] = value
    return mixed(out).view(np.int64)


def signature(firsts: np.ndarray) -> bytes:
    """An odd sketch: a bit per hash value, flipped by each distinct shingle.

    The exclusive or of two sketches is the sketch of the shingles that only one text has.
    """
    at = (mixed(firsts) >> np.uint64(64 - SIGNATURE_BITS.bit_length() + 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=SIGNATURE_BITS) & 1).tobytes()


def signature_words(signatures: Sequence[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), np.uint64).reshape(-1, SIGNATURE_BITS // 64)


def close(a: np.ndarray, b: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Whether signatures ``a`` and ``b`` allow the similarity of texts with ``total`` shingles.

    At the similarity wanted at most d shingles differ. d balls in m bins leave
    m/2 (1 - exp(-2d/m)) odd bins on average; the test allows DEVIATIONS more than that.
    Long texts fill their sketch, and then the test lets everything pass.
    """
    m, d = SIGNATURE_BITS, total * (1 - SIMILARITY) / (1 + SIMILARITY)
    mean = m / 2 * (1 - np.exp(-2 * d / m))
    variance = np.maximum(0, m / 4 * (1 - np.exp(-4 * d / m)) - d * np.exp(-4 * d / m))
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64) <= mean + DEVIATIONS * np.sqrt(variance) + 1


def in_size(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether documents with so many shingles can be similar enough at all."""
    return np.minimum(a, b) >= SIMILARITY * np.maximum(a, b)


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """The most shingles that an alignment matches within ``band`` of the diagonal.

    Both texts hold each shingle once, so that is the longest increasing subsequence of the places
    in ``b`` of the shingles of ``a``, found by the ends of the best subsequences of each length:
    its work is n log n however the texts differ.
    """
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    order = np.argsort(i)
    places = j[order][np.abs(i - j)[order] <= band]
    if (places[1:] > places[:-1]).all():
        return len(places)
    ends: list[int] = []
    for place in places.tolist():
        if not ends or place > ends[-1]:
            ends.append(place)
        else:
            ends[bisect_left(ends, place)] = place
    return len(ends)


def similar(a: list[bytes], b: list[bytes]) -> bool:
    """Whether aligned shingles reach ``SIMILARITY``; exact.

    An alignment that reaches it leaves few shingles of either text unmatched, and none of its
    pairs can be further from the diagonal than that; so the rest of the table is not looked at.
    """
    if a == b:
        return True
    if min(len(a), len(b)) < SHINGLE:
        return False
    sa, sb = (occurrences(shingle_hashes(x))[1] for x in (a, b))
    total = len(sa) + len(sb)
    if not in_size(len(sa), len(sb)):
        return False
    matched = aligned(sa, sb, int(total * (1 - SIMILARITY) / (1 + SIMILARITY)) + 1)
    return matched >= SIMILARITY * (total - matched)


def profiles(documents: DataFrame) -> DataFrame:
    """Key, exact hash of the words, number of distinct shingles, sketches and signature of each document."""

    def rows(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"exact": [], "n_shingles": [], "sketches": [], "signature": []}
        for text in batch["text"]:
            tokens = words(text.as_py())
            labelled, firsts = occurrences(shingle_hashes(tokens))
            out["exact"].append(xxhash.xxh3_128_digest(b" ".join(tokens)) if tokens else None)
            out["n_shingles"].append(len(firsts))
            out["sketches"].append(order_sketches(labelled, firsts) if len(firsts) else None)
            out["signature"].append(signature(firsts) if len(firsts) else None)
        return {"doc_id": batch["doc_id"], "key": batch["key"], **out}

    return in_arrow(keyed(documents), rows, PROFILE)


def keyed(documents: DataFrame) -> DataFrame:
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(doc_id.alias("doc_id"), text_key(doc_id, text).alias("key"), text.alias("text"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of undirected edges (u, v); root is the smallest node.

    Large-star and small-star rounds: each node hands its neighbours to the smallest of them,
    until nothing changes. Rounds grow with the logarithm of the longest path.
    """
    edges = stage(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
                  .distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
                edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
        before = tuple(state)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = stage(both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").distinct(), "large-star")
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(least, "v")
        edges = stage(joined.select(F.col("m").alias("u"), "v").unionByName(
            joined.select(F.col("m").alias("u"), F.col("u").alias("v")).where("u <> v")).distinct(), "small-star")


def estimated_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sizes and signatures allow the similarity."""
    side = lambda c: nodes.select(F.col("key").alias(c), *(F.col(x).alias(f"{c}_{x}") for x in SIDE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (signature_words(batch[c].to_pylist()) for c in ("u_signature", "v_signature"))
            u, v = (batch[c].to_numpy() for c in ("u_size", "v_size"))
            good = in_size(u, v) & close(a, b, u + v)
            yield batch.select(["u", "v"]).filter(pa.array(good))

    joined = pairs.join(side("u"), "u").join(side("v"), "v")
    return joined.select("u", "v", "u_size", "v_size", "u_signature", "v_signature").mapInArrow(run, "u long, v long")


def verified(pairs: DataFrame, documents: DataFrame) -> DataFrame:
    """The pairs (u, v) of keys whose texts are similar."""
    pairs = stage(pairs.distinct(), "pairs")
    needed = stage(pairs.select(F.col("u").alias("key")).unionByName(pairs.select(F.col("v").alias("key"))).distinct(),
                   "needed")
    found = keyed(documents).select("key", "text").join(
        F.broadcast(needed) if needed.count() * 16 <= broadcast_budget(needed.sparkSession) else needed, "key", "left_semi")
    texts = stage(found.dropDuplicates(["key"]), "texts")
    sides = pairs.join(texts.select(F.col("key").alias("u"), F.col("text").alias("a")), "u").join(
        texts.select(F.col("key").alias("v"), F.col("text").alias("b")), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [similar(words(a.as_py()), words(b.as_py())) for a, b in zip(batch["a"], batch["b"])]
            yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    return sides.select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def bucket_members(nodes: DataFrame) -> DataFrame:
    """(key, size, bucket, n) of every sketch that n > 1 nodes share."""
    members = stage(nodes.select("key", "size", F.explode("sketches").alias("bucket")), "members")
    sizes = stage(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    return stage(left_join_sized(members, sizes, ["bucket"], sizes.count() * 16).where("n is not null"), "shared")


def pivot_pairs(members: DataFrame) -> DataFrame:
    """Each bucket member with the bucket's pivot: the member that shares the most sketches."""
    weight = members.groupBy("key").agg(F.sum("n").alias("weight"))
    pivot = members.join(weight, "key").groupBy("bucket").agg(
        F.max(F.struct("weight", F.col("key").alias("v"))).alias("p")).select("bucket", "p.v")
    return members.join(pivot, "bucket").where("key <> v").select(F.col("key").alias("u"), "v").distinct()


def cross_pairs(members: DataFrame, roots: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of bucket members in different components that their signatures allow.

    A bucket of many members is cut into blocks, and each task compares two blocks. Sizes of one
    class differ by less than the similarity allows, and those of classes that are not neighbours
    by more, so only blocks of one class or of neighbours meet.
    """
    rooted = left_join_sized(members, roots.withColumnRenamed("node", "key"), ["key"], roots.count() * 24)
    rooted = stage(rooted.withColumn("root", F.coalesce("root", "key")), "rooted")
    split = stage(rooted.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b"))
                  .where("a <> b").select("bucket", F.lit(True).alias("split")), "split")
    parted = left_join_sized(rooted, split, ["bucket"], split.count() * 16).where("split")
    parted = parted.withColumn("class", F.when(
        F.col("n") > BLOCK_ROWS, F.floor(F.log("size") / -math.log(SIMILARITY))).otherwise(0).cast("long"))
    in_order = Window.partitionBy("bucket").orderBy("class")
    beside = lambda row, step: F.when(
        row("class").over(in_order) == F.col("class") + step, row("blocks").over(in_order))
    classes = parted.where(F.col("n") > BLOCK_ROWS).groupBy("bucket", "class").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("blocks"))
    classes = stage(classes.select("bucket", "class", "blocks", beside(F.lag, -1).alias("below"), beside(F.lead, 1).alias("above")),
                    "classes-of-size")
    parted = left_join_sized(parted, classes, ["bucket", "class"], classes.count() * 40).withColumn("blocks", F.coalesce("blocks", F.lit(1)))

    def numbers(size_class: Column, blocks: str) -> Column:
        """The numbers of a class's blocks, none if there is no such class."""
        first = size_class * F.lit(1 << 32)
        return F.coalesce(F.sequence(first, first + F.col(blocks) - 1), F.array().cast("array<bigint>"))

    mine = F.col("class") * F.lit(1 << 32) + F.pmod(F.xxhash64("key"), "blocks")
    others = F.concat(numbers(F.col("class"), "blocks"), numbers(F.col("class") - 1, "below"), numbers(F.col("class") + 1, "above"))
    blocked = parted.withColumn("block", mine).withColumn("other", F.explode(others)).select(
        "bucket", "key", "root", "block",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    blocked = blocked.join(nodes.select("key", *SIDE), "key")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", kind="stable")
        sigs = signature_words(rows["signature"])
        key, size, root, block = (rows[c].to_numpy() for c in ("key", "size", "root", "block"))
        same_block = rows["low"].iloc[0] == rows["high"].iloc[0]
        # In order of size, those that can be similar to a row follow it closely.
        ends = np.searchsorted(size, size / SIMILARITY * (1 + 1e-9), side="right")
        out = []
        for i, end in enumerate(ends):
            after = slice(i + 1, end)
            apart = (root[after] != root[i]) & (same_block | (block[after] != block[i]))
            if apart.any():
                good = np.flatnonzero(apart & close(sigs[i], sigs[after], size[i] + size[after])) + i + 1
                out += [(min(key[i], key[j]), max(key[i], key[j])) for j in good]
        return pd.DataFrame(out, columns=["u", "v"])

    return blocked.groupBy("bucket", "low", "high").applyInPandas(run, "u long, v long").distinct()


def near_duplicates(documents: DataFrame) -> DataFrame:
    """A row per document: doc_id, key, class_id, class_key, class_size.

    Documents are linked if their aligned five-word shingles have a similarity of 0.8 or
    more (see ``similar``; repetitions count once), and a class holds all that links connect; class_id is its smallest doc_id (null
    ids last) and class_key names the row that has it. Words are as in ``common.words``, so
    case and white space do not count. Texts of fewer than five words are similar only if
    equal. Null texts and texts without a word are alone in a class each for itself. Rows that
    repeat doc_id and text have one key and one class. An empty table gives no rows.

    Candidates come from sketches: a pair at 0.8 shares none with a chance of about 1e-7 (up to
    1e-3 where texts repeat themselves or have a handful of words). A very long text is one row
    of its task, with 8 bytes of hashes for each of its words; aligning two takes n log n.
    """
    profile = stage(profiles(documents), "profiles")
    copies = stage(profile.where(F.col("exact").isNotNull()).groupBy("exact").agg(F.min("key").alias("key")), "copies")
    # A key that rows repeat has one profile, so the first of them will do.
    nodes = stage(profile.where("n_shingles > 0").join(copies.select("key"), "key", "left_semi").groupBy("key").agg(
        F.first("n_shingles").alias("size"), F.first("signature").alias("signature"),
        F.first("sketches").alias("sketches")), "nodes")
    members = bucket_members(nodes)

    first = stage(verified(estimated_pairs(pivot_pairs(members), nodes), documents), "links")
    second = verified(cross_pairs(members, components(first), nodes), documents)
    roots = components(first.unionByName(second))

    exact = stage(left_join_sized(copies, roots.withColumnRenamed("node", "key"), ["key"], roots.count() * 24)
                  .select("exact", F.coalesce("root", "key").alias("root")), "roots")
    rows = left_join_sized(profile.select("doc_id", "key", "exact"), exact, ["exact"], exact.count() * ROW_BYTES)
    rows = stage(rows.select("doc_id", "key", F.coalesce("root", "key").alias("root"), F.col("exact").isNull().alias("__alone")),
                 "classed")
    named = stage(rows.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("x"),
        F.count(F.lit(1)).alias("class_size")), "classes")
    named = named.select("root", F.col("x.doc_id").alias("class_id"), F.col("x.key").alias("class_key"), "class_size")
    size = named.count() * ROW_BYTES
    joined = left_join_sized(rows, named, ["root"], size)
    alone = F.col("__alone")
    return joined.select(
        "doc_id", "key", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("key")).otherwise(F.col("class_key")).alias("class_key"),
        F.when(alone, F.lit(1).cast("long")).otherwise(F.col("class_size")).alias("class_size"))


def keep_one(documents: DataFrame) -> DataFrame:
    """The documents that give their class its id: one row of each class, columns as they are.

    Of rows that repeat doc_id and text one stays, also where the text has no word.
    """
    classes = near_duplicates(documents)
    kept = stage(classes.where(F.col("key") == F.col("class_key")).groupBy("key").agg(
        F.count(F.lit(1)).alias("__times")), "kept")
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    tagged = documents.withColumn("__key", text_key(doc_id, text))
    chosen = left_join_sized(tagged, kept.withColumnRenamed("key", "__key"), ["__key"], kept.count() * 16)
    # Only rows repeated whole have to be compared once more.
    once = chosen.where("__times = 1")
    repeated = chosen.where("__times > 1").dropDuplicates(["__key"])
    return once.unionByName(repeated).select(documents.columns)
