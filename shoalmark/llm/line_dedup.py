"""Deletes later copies of repeated line runs, found by prefix doubling over line ids.

Documents are sequences of line ids. Suffixes are ranked by their first line, then by their
first two, four, ... lines: the rank of a suffix by 2h lines is the place of the pair (its
rank by h lines, the rank by h lines of the suffix h lines further on) in the sorted pairs.
Suffixes with one rank share a prefix of that length, which is an interval of the suffix
array with at least that common prefix; a run of any length L is such an interval, named by
the two ranks of depth 2**k <= L that cover it.

A run counts if it has ``min_words`` words. Every such run is the union of shortest such
runs, one from each of its lines forwards or backwards, and what repeats as a whole repeats
in its parts. So doubling may stop at the longest shortest run, which has at most
``min_words`` lines, and the lines deleted are exactly those of all maximal repeated runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoalmark.llm.common import left_join_sized, other_columns, text_key, unused_names
from shoalmark.llm.quality import once
from shoalmark.session import stage

MIN_WORDS = 10
WORD = r"[^\x20\x09-\x0D]+"
ROW_BYTES = 48  # of a staged rank or class, when its table's size is estimated


def line_rows(documents: DataFrame) -> DataFrame:
    """Lines with a word: doc_id, key, seq among those, line number, id in two hashes, words."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("line"), x.alias("text"))),
                     lambda x: x["text"].rlike(WORD))
    # The key first, as what stands beside a generator is worked out for each of its rows.
    keyed = documents.select(doc_id.alias("doc_id"), text_key(doc_id, text).alias("key"), lines.alias("lines"))
    rows = keyed.select("doc_id", "key", F.posexplode("lines").alias("seq", "x"))
    return rows.select("doc_id", "key", "seq", F.col("x.line").alias("line"),
                       F.xxhash64("x.text").alias("a"), F.hash("x.text").alias("b"),
                       F.regexp_count("x.text", F.lit(WORD)).alias("words"))


def ranked(groups: DataFrame, by: list[str], name: str) -> DataFrame:
    """Rank of each combination of ``by`` that occurs at least twice, in sorted order."""
    twice = groups.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    return stage(twice.orderBy(*by).select(*by, F.monotonically_increasing_id().alias(name)), "ranks")


def with_ranks(rows: DataFrame, ranks: DataFrame, by: list[str]) -> DataFrame:
    return left_join_sized(rows, ranks, by, ranks.count() * ROW_BYTES)


def suffix_ranks(lines: DataFrame, depth: int) -> DataFrame:
    """Rows of repeated lines with ranks r0, r1, ... by their first 1, 2, 4, ... <= depth lines.

    A rank is null where the run of that length ends the document or occurs only once;
    ranks that are set are in the order of the runs.
    """
    first = ranked(lines, ["a", "b"], "r0")
    # Rows repeated whole in the input are one document.
    rows = stage(with_ranks(lines, first, ["a", "b"]).where(F.col("r0").isNotNull())
                 .drop("a", "b").dropDuplicates(["doc_id", "key", "seq"]), "suffixes")
    level = 0
    while 2 << level <= depth:
        here, ahead = f"r{level}", Window.partitionBy("doc_id", "key").orderBy("seq")
        step = 1 << level
        paired = rows.withColumn("__next", F.max(here).over(ahead.rangeBetween(step, step)))
        whole = paired.where(F.col(here).isNotNull() & F.col("__next").isNotNull())
        ranks = ranked(whole, [here, "__next"], f"r{level + 1}")
        rows = stage(with_ranks(paired, ranks, [here, "__next"]).drop("__next"), "suffixes")
        level += 1
    return rows


def shortest_runs(rows: DataFrame, min_words: int) -> DataFrame:
    """For each line the shortest run with enough words that begins, and that ends, there."""
    levels = sorted((c for c in rows.columns if c[0] == "r" and c[1:].isdigit()), key=lambda c: int(c[1:]))
    cell = F.struct("seq", "line", "words", *levels)
    doc = Window.partitionBy("doc_id", "key").orderBy("seq")
    around = {"ahead": doc.rowsBetween(0, min_words - 1), "behind": doc.rowsBetween(1 - min_words, 0)}

    def length(cells: Column, step: int) -> Column:
        """Lines until the words suffice, or null if the lines break off before."""
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("words"), F.lit(True).alias("open"))

        def add(s: Column, x: Column) -> Column:
            joined = s["open"] & (x["seq"] == F.get(cells, F.lit(0))["seq"] + step * s["n"])
            grown = s["words"] + x["words"]
            return F.when(joined, F.struct((s["n"] + 1).alias("n"), grown.alias("words"),
                                           (grown < min_words).alias("open"))) \
                .otherwise(F.struct(s["n"].alias("n"), s["words"].alias("words"), F.lit(False).alias("open")))

        return F.aggregate(cells, start, add, lambda s: F.when(s["words"] >= min_words, s["n"]))

    cells = rows.select("doc_id", "key", *(F.collect_list(cell).over(w).alias(c) for c, w in around.items()))
    cells = cells.withColumn("behind", F.reverse("behind"))
    ahead = cells.select("doc_id", "key", F.col("ahead").alias("cells"), length(F.col("ahead"), 1).alias("n"))
    behind = cells.select("doc_id", "key", F.col("behind").alias("cells"), length(F.col("behind"), -1).alias("n"))
    runs = ahead.select("doc_id", "key", "n", F.slice("cells", F.lit(1), F.coalesce("n", F.lit(0))).alias("cells")) \
        .unionByName(behind.select("doc_id", "key", "n", F.reverse(
            F.slice("cells", F.lit(1), F.coalesce("n", F.lit(0)))).alias("cells")))
    # A run of n lines is named by its length and the ranks of the two halves that cover it.
    left, right = F.lit(None).cast("long"), F.lit(None).cast("long")
    for k, name in enumerate(levels):
        at_level = (F.col("n") >= 1 << k) & (F.col("n") < 2 << k)
        left = F.when(at_level, F.get("cells", F.lit(0))[name]).otherwise(left)
        right = F.when(at_level, F.get("cells", F.col("n") - (1 << k))[name]).otherwise(right)
    return runs.where(F.col("n").isNotNull()).select(
        "doc_id", "key", F.get("cells", F.lit(0))["seq"].alias("seq"), "n",
        left.alias("left"), right.alias("right"), F.col("cells.line").alias("lines")) \
        .where(F.col("left").isNotNull() & F.col("right").isNotNull())


def removed_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, key, line) of every line in a later copy of a repeated run."""
    lines = stage(line_rows(documents), "lines")
    runs = stage(shortest_runs(suffix_ranks(lines, min_words), min_words), "runs")
    by = ["n", "left", "right"]
    first = stage(runs.groupBy(*by).agg(F.min(F.struct("doc_id", "key", "seq")).alias("first")), "first")
    later = left_join_sized(runs, first, by, first.count() * ROW_BYTES).where(
        F.struct("doc_id", "key", "seq") > F.col("first"))
    return later.select("doc_id", "key", F.explode("lines").alias("line")).distinct()


def maximal_runs(removed: DataFrame) -> DataFrame:
    """(doc_id, key, first_line, n_lines) of the removed lines, joined where they are next to
    each other in the document."""
    doc = Window.partitionBy("doc_id", "key").orderBy("line")
    return (removed.withColumn("__island", F.col("line") - F.row_number().over(doc))
            .groupBy("doc_id", "key", "__island")
            .agg(F.min("line").alias("first_line"), F.count(F.lit(1)).alias("n_lines")).drop("__island"))


def dedup_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``documents`` with later copies of repeated line runs taken out of their texts.

    Adds n_lines and n_removed (columns of these names are replaced). Lines are cut at \\n
    and compared exactly; lines without a word are no part of any run, never removed, and do
    not separate lines. The first copy is the one at the smallest (doc_id, hash of the text,
    line), null ids first. Rows that repeat both doc_id and text are one document and get the
    same result. A null text stays null; an empty table gives no rows. Nothing is cut off
    from long texts; only a document's own lines ever meet in one task.
    """
    doc, key, gone, lines = unused_names(documents, "__doc", "__key", "__removed", "__lines")
    removed = stage(removed_lines(documents, min_words).groupBy("doc_id", "key").agg(F.collect_list("line").alias(gone)).select(
        F.coalesce("doc_id", F.lit(0)).alias(doc), F.col("key").alias(key), gone), "removed")
    size = removed.agg(F.coalesce(F.sum(32 + 4 * F.size(gone)), F.lit(0)).alias("n")).first().n
    own = [f"`{c}`" for c in other_columns(documents, ("n_lines", "n_removed"))]
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = documents.select(*own, F.coalesce(doc_id, F.lit(0)).alias(doc), text_key(doc_id, text).alias(key))
    joined = left_join_sized(keyed, removed, [doc, key], size).withColumn(
        gone, F.coalesce(gone, F.array().cast("array<int>"))).withColumn(lines, once(F.split(text, "\n", -1)))
    # Numbers of the lines that stay, by hashing, and then the lines themselves.
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col(lines), i)), "\n")
    changed = F.when(F.size(gone) > 0, kept).otherwise(F.col("text"))
    return joined.select(
        *(c for c in own if c.lower() != "`text`"), changed.alias("text"),
        F.size(lines).alias("n_lines"), F.size(gone).alias("n_removed"))
