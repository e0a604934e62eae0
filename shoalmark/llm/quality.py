"""Line-first quality rules, in DataFrame expressions only.

Each line is tested on its own for punctuation, navigation and boilerplate. Lines that fail
are removed, and a document that loses too much of its text that way is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalmark.llm.common import other_columns, unused_names

# Fixed values of the base counts: the six white-space characters between words and the
# characters counted as symbols.
SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"

# Line rules. A line has the end of a sentence, few symbols and few calls, is no menu, and
# if short holds no stock phrase.
SENTENCE_END = r"""[.!?:;…。！？]["'”’»)\]]*([\x20\x09-\x0D]|\z)"""
HAS_WORD = r"[^\x20\x09-\x0D]"
SEPARATORS = "|>»·•"
MOST_SYMBOLS = 0.05
MOST_CALLS = 0.05
MOST_SEPARATORS = 2
SHORT_LINE = 200
STOCK_PHRASES = (
    r"(?i)javascript|cookie|lorem ipsum|terms of use|terms of service|privacy policy"
    r"|all rights reserved|licensed under|released under the|sign in|log in|read more"
    r"|click here|skip to content|subscribe to our|copyright ©")
LEAST_KEPT = 0.7
LEAST_WORDS = 50

# Bits of a packed window that hold its place; the rest hold its hash.
PLACE_BITS = 28


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def once(array: Column) -> Column:
    """``array`` computed once per row. The condition always holds, but being
    non-deterministic it keeps the optimizer from copying the array's expression into the
    functions applied to its elements, where it would run again for every element."""
    return F.when(F.monotonically_increasing_id() >= 0, array)


def count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(without(text, characters))


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(HAS_WORD))


def packed_windows(words: Column) -> Column:
    """Each window of three words as one number: a hash in the high bits, its place in the low."""
    high = F.lit(-(1 << PLACE_BITS))
    return F.when(F.size(words) >= 3, F.transform(
        F.slice(words, F.lit(1), F.size(words) - 2),
        lambda word, i: F.xxhash64(word, F.get(words, i + 1), F.get(words, i + 2))
        .bitwiseAND(high).bitwiseOR(i.cast("long")))).otherwise(F.array().cast("array<long>"))


def repeated_places(words: Column, ordered: Column) -> Column:
    """Places of windows that occur more than once: equal to a neighbour in hash order.

    Windows whose hashes agree are compared word by word. Where different windows have one
    hash, copies need not be neighbours; such a text is put in order by the words themselves.
    """
    high, low = F.lit(-(1 << PLACE_BITS)), F.lit((1 << PLACE_BITS) - 1)

    def one_hash(a: Column, b: Column) -> Column:
        return a.bitwiseAND(high) == b.bitwiseAND(high)

    def one_text(a: Column, b: Column) -> Column:
        words_equal = [F.get(words, a.bitwiseAND(low).cast("int") + j)
                       == F.get(words, b.bitwiseAND(low).cast("int") + j) for j in range(3)]
        return words_equal[0] & words_equal[1] & words_equal[2]

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(one_hash(a, b) & one_text(a, b), F.lit(False))

    def clash(a: Column, b: Column) -> Column:
        return F.coalesce(one_hash(a, b) & ~one_text(a, b), F.lit(False))

    found = F.filter(ordered, lambda v, k: same(v, F.get(ordered, k - 1)) | same(v, F.get(ordered, k + 1)))
    clashes = F.size(F.filter(ordered, lambda v, k: clash(v, F.get(ordered, k + 1)))) > 0
    return F.when(clashes, places_by_words(words)).otherwise(
        F.sort_array(F.transform(found, lambda v: v.bitwiseAND(low))))


def places_by_words(words: Column) -> Column:
    """The same places by sorting all windows by their words."""
    windows = F.sort_array(F.transform(
        F.slice(words, F.lit(1), F.size(words) - 2),
        lambda word, i: F.struct(F.struct(word.alias("a"), F.get(words, i + 1).alias("b"), F.get(words, i + 2).alias("c"))
                                 .alias("text"), i.cast("long").alias("place"))))

    def copies(ordered: Column) -> Column:
        return F.filter(ordered, lambda v, k: F.coalesce(v["text"] == F.get(ordered, k - 1)["text"], F.lit(False))
                        | F.coalesce(v["text"] == F.get(ordered, k + 1)["text"], F.lit(False)))

    # A variable of a function is computed once, an expression in it for every element.
    found = F.get(F.transform(F.array(windows), copies), F.lit(0))
    return F.sort_array(F.transform(found, lambda v: v["place"]))


def words_covered(places: Column) -> Column:
    """Words in windows of three that begin at the sorted ``places``, each counted once."""
    return F.aggregate(
        F.transform(places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"), lambda total, n: total + n)


def line_passes(line: Column) -> Column:
    sentence = line.rlike(SENTENCE_END)
    quiet = ((count_of(line, SYMBOLS) <= MOST_SYMBOLS * F.length(line))
             & (count_of(line, "!?") <= MOST_CALLS * F.length(line)))
    menu = count_of(line, SEPARATORS) > MOST_SEPARATORS
    stock = (F.length(line) <= SHORT_LINE) & line.rlike(STOCK_PHRASES)
    return sentence & quiet & ~menu & ~stock


def assess(documents: DataFrame) -> DataFrame:
    """The columns of ``documents`` and their counts, verdict and cleaned text.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and
    clean_text; a column of the input that has one of these names is replaced. A null text
    counts as empty and so fails the base rule (under 50 words). Every row is judged for
    itself, so repeated rows get the same verdict and an empty table gives no rows. Texts
    may have up to 2**28 words. No shuffle, and no code outside the JVM.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             "kept", "clean_text")
    own = [f"`{c}`" for c in other_columns(documents, added)]
    hidden = words, lines, windows, places, clean = unused_names(
        documents, "__words", "__lines", "__windows", "__places", "__clean")
    step = documents.select(*own, once(split_words(text)).alias(words),
                            once(lines_with_words(text)).alias(lines))
    step = step.withColumn(windows, once(F.sort_array(packed_windows(F.col(words)))))
    step = step.withColumn(places, once(repeated_places(F.col(words), F.col(windows))))
    step = step.withColumn(clean, once(F.array_join(F.filter(lines, line_passes), "\n")))
    chars = F.length(without(text, SPACES)).cast("long")
    counted = step.select(
        *own, *hidden, F.size(words).cast("long").alias("n_words"), chars.alias("word_chars"),
        count_of(text, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        words_covered(F.col(places)).alias("n_repeat_words"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    enough = F.length(without(F.col(clean), SPACES)) >= LEAST_KEPT * F.col("word_chars")
    return counted.select(
        *own, *added[:5], failed.alias("base_failed"), (~failed & enough).alias("kept"),
        F.col(clean).alias("clean_text"))
