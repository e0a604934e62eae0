"""Bigram scoring with a log-frequency Bloom filter.

Counts are quantised to levels that grow by a constant factor. The filter holds each n-gram
once for every level up to its own, so probing level after level until one is missing gives
the level back. It has as many bits as the counted n-grams need, each at its own level, and is
built in slices by the tasks that count. It is broadcast if it fits the budget; if not, the
n-grams of the texts are dealt to the slices, which gives the same levels. Probabilities mix
the bigram's and the word's relative frequency; the weight for each level of the history is
fitted with every training token left out of the counts it is scored by.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalmark.llm.common import hash_words, remainder, text_key, words
from shoalmark.session import broadcast_budget, stage

FACTOR = 1.5  # from one level to the next
LEVELS = 120  # reaches counts beyond 2**63
PROBES = 3
FILTER_BITS = 28  # 2**28 bits: 32 MB, the least size of the filter
FILL = 0.69  # settings a bit, at which half of the bits stay clear
ASKED_BYTES = 64 << 20  # n-grams that meet a slice of the filter at a time
KNOWN_WORDS = 1 << 20  # most frequent words whose exact counts are broadcast: 16 MB
COUNT_SLICE, SCORE_SLICE = 1_000_000, 250_000  # tokens that a task works on at a time
UNIGRAM, BIGRAM = 0, 1
PART_BYTES = 32 << 20  # of counts that meet in a part, at most about
MOST_TASK_BITS = 16  # tasks that count parts; beyond that a task counts several, one at a time
TOKEN_BYTES = 5  # of text to a token, at least, in natural text
WEIGHTS = np.array([0.001, 0.01, 0.03, 0.1, 0.2, 0.35, 0.5, 0.7, 0.85, 0.95, 0.99])

# Hashes that no word has a part in: words hold no white space.
END, START = (np.uint64(h) for h in hash_words([b"\n", b"\t"]))
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))

GRAMS = "kind int, part int, hashes binary, counts binary, histogram array<long>"
CHUNKS = "chunk long, ids array<long>, keys array<long>, words binary, places binary, ends array<long>"
SCORED = ("doc_id long, key long, held_out boolean, n_tokens long, known long, base double, score double, "
          "rare array<long>, times array<long>")


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def levels_of(counts: np.ndarray) -> np.ndarray:
    """1 for a count of 1, and one more for each factor of FACTOR; 0 for 0."""
    return np.searchsorted(_THRESHOLDS, counts, side="right")


_THRESHOLDS = np.concatenate([[1.0], FACTOR ** np.arange(1, LEVELS)])
# The count that a level stands for: the mean of the whole numbers it covers, roughly.
_LOW = np.ceil(_THRESHOLDS)
_TOP = np.maximum(_LOW, np.ceil(np.append(_THRESHOLDS[1:], _THRESHOLDS[-1] * FACTOR)) - 1)
VALUES = np.concatenate([[0.0], (_LOW + _TOP) / 2])


def token_hashes(text: str | None) -> np.ndarray:
    tokens = words(text)
    out = np.empty(len(tokens) + 1, dtype=np.uint64)
    out[:-1] = np.fromiter(hash_words(tokens), dtype=np.uint64, count=len(tokens))
    out[-1] = END
    return out


def slices(batch: pa.RecordBatch, most: int = SCORE_SLICE) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(rows, all their tokens, where each row's tokens end), some rows at a time."""
    rows, arrays, size = [], [], 0
    for k, text in enumerate(batch["text"]):
        rows.append(k)
        arrays.append(token_hashes(text.as_py()))
        size += len(arrays[-1])
        if size >= most or k == batch.num_rows - 1:
            yield rows, np.concatenate(arrays), np.cumsum([len(a) for a in arrays])
            rows, arrays, size = [], [], 0


def histories(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    before = np.roll(tokens, 1)
    before[0] = START
    before[ends[:-1]] = START
    return before


def bigrams(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mixed(before * _A + tokens)


def counted(hashes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, with the sum of their counts."""
    if counts is None:
        return np.unique(hashes, return_counts=True)
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])[:len(hashes)])
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


def cut(hashes: np.ndarray, shift: np.uint64) -> np.ndarray:
    """Where sorted hashes go over from one part to the next."""
    return np.flatnonzero(np.diff((hashes >> shift).astype(np.int64))) + 1


def training(docs: DataFrame, folds: int, held_fold: int) -> DataFrame:
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))
    return docs.where(fold.isNull() | (fold != held_fold))


def part_bits(docs: DataFrame) -> int:
    """Parts (as a power of two) that keep about PART_BYTES of counts each, from the size of the
    texts: a token leaves at most a word and a bigram of twelve bytes each in its task's counts."""
    size = docs.agg(F.sum(F.octet_length("text").cast("double"))).first()[0] or 0.0
    return min(20, max(3, int(size / TOKEN_BYTES * 24 / PART_BYTES).bit_length()))


def count_grams(docs: DataFrame, parts_bits: int) -> DataFrame:
    """Counts of all words and bigrams, in blocks of sorted hashes; one block per kind and part.

    Tasks count what they read, cut it by the hash's top bits and hand on blocks, so that a
    frequent n-gram reaches its part once per task. There are more parts and tasks for more text,
    and a task holds one part at a time, so neither grows with the corpus.
    """
    shift = np.uint64(64 - parts_bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, tokens, ends in slices(batch, COUNT_SLICE):
                for kind, grams in ((UNIGRAM, tokens), (BIGRAM, bigrams(histories(tokens, ends), tokens))):
                    hashes, counts = counted(grams)
                    cuts = cut(hashes, shift)
                    blocks = list(zip(np.split(hashes, cuts), np.split(counts.astype("<u4"), cuts)))
                    yield pa.RecordBatch.from_pydict({
                        "kind": pa.array([kind] * len(blocks), pa.int32()),
                        "part": pa.array([int(h[0] >> shift) for h, _ in blocks], pa.int32()),
                        "hashes": pa.array([h.tobytes() for h, _ in blocks], pa.binary()),
                        "counts": pa.array([c.tobytes() for _, c in blocks], pa.binary())})

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        kind = int(rows["kind"].iloc[0])
        hashes, counts = counted(np.frombuffer(b"".join(rows["hashes"]), np.uint64),
                                 np.frombuffer(b"".join(rows["counts"]), "<u4").astype(np.int64))
        histogram = np.bincount(levels_of(counts), minlength=LEVELS + 1)
        return pd.DataFrame({"kind": [kind], "part": [int(rows["part"].iloc[0])], "hashes": [hashes.tobytes()],
                             "counts": [counts.astype("<i8").tobytes()], "histogram": [histogram.tolist()]})

    blocks = docs.select("text").mapInArrow(count, "kind int, part int, hashes binary, counts binary")
    dealt = blocks.repartition(1 << min(parts_bits, MOST_TASK_BITS), "kind", "part")
    return stage(dealt.groupBy("kind", "part").applyInPandas(total, GRAMS), "grams")


def positions(grams: np.ndarray, level: int, probe: int, parts_bits: int, bits: int) -> np.ndarray:
    """Bit of an n-gram's level: the slice goes by the hash's top bits, the place by a new hash."""
    salt = np.uint64((level * PROBES + probe + 1) * int(_A) & (1 << 64) - 1)
    within = mixed(grams + salt) & np.uint64((1 << bits - parts_bits) - 1)
    return ((grams >> np.uint64(64 - parts_bits)) << np.uint64(bits - parts_bits)) | within


def fill_slice(rows: Iterable[tuple[int, bytes, bytes]], least: dict[int, int], parts_bits: int, bits: int) -> np.ndarray:
    """The bytes of a slice that holds the n-grams of ``rows`` (kind, hashes, counts)."""
    size = 1 << bits - parts_bits
    there = np.zeros(size, dtype=bool)
    for kind, hashes, counts in rows:
        hashes, level = np.frombuffer(hashes, np.uint64), levels_of(np.frombuffer(counts, "<i8"))
        hashes, level = hashes[level >= least[kind]], level[level >= least[kind]]
        for j in range(1, int(level.max(initial=0)) + 1):
            for probe in range(PROBES):
                there[(positions(hashes[level >= j], j, probe, parts_bits, bits) & np.uint64(size - 1))
                      .astype(np.int64)] = True
    return np.packbits(there, bitorder="little")


def probed(there: np.ndarray, grams: np.ndarray, least: int, parts_bits: int, bits: int) -> np.ndarray:
    """Level of each n-gram by probing one level after the other; 0 if it is not stored.

    ``there`` is the whole filter, or the slice that all of ``grams`` belong to.
    """
    out = np.zeros(len(grams), dtype=np.int64)
    at, within = np.arange(len(grams)), np.uint64(8 * len(there) - 1)
    for level in range(1, LEVELS + 1):
        for probe in range(PROBES):
            bit = positions(grams[at], level, probe, parts_bits, bits) & within
            at = at[(there[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        if not len(at):
            break
        out[at] = level
    out[out < least] = 0
    return out


def build_filter(grams: DataFrame, least: dict[int, int], parts_bits: int, bits: int) -> np.ndarray:
    """The filter's bytes, put together from one slice per kind and part (2**bits bits each kind)."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, part, hashes, counts in zip(*(batch[c].to_pylist() for c in ("kind", "part", "hashes", "counts"))):
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part], pa.int32()),
                    "slice": pa.array([fill_slice([(kind, hashes, counts)], least, parts_bits, bits).tobytes()],
                                      pa.binary())})

    out = np.zeros(1 << bits - 3, dtype=np.uint8)
    width = 1 << bits - parts_bits - 3
    for row in grams.select("kind", "part", "hashes", "counts").mapInArrow(fill, "part int, slice binary").toLocalIterator():
        out[row.part * width:(row.part + 1) * width] |= np.frombuffer(row.slice, np.uint8)
    return out


def stored_load(histogram: dict[int, np.ndarray], least: dict[int, int]) -> dict[int, float]:
    """Bits set for each kind if it is stored from its least level on."""
    level = np.arange(LEVELS + 1)
    return {kind: float((histogram[kind] * level)[least[kind]:].sum()) * PROBES for kind in (UNIGRAM, BIGRAM)}


def all_levels() -> dict[int, int]:
    """Least levels at which every counted n-gram is stored."""
    return {UNIGRAM: 1, BIGRAM: 1}


def bits_needed(histogram: dict[int, np.ndarray], at_least: int) -> int:
    """Bits (as a power of two) that store every counted n-gram and leave half of them clear."""
    load, bits = sum(stored_load(histogram, all_levels()).values()), at_least
    while load > FILL * (1 << bits):
        bits += 1
    return bits


def least_levels(histogram: dict[int, np.ndarray], bits: int) -> dict[int, int]:
    """Lowest level stored of each kind in a filter whose size the caller has fixed: as low as
    keeps half of its bits clear. Bigrams give way first, then words.
    """
    least = all_levels()
    while sum((load := stored_load(histogram, least)).values()) > FILL * (1 << bits):
        least[BIGRAM if load[BIGRAM] else UNIGRAM] += 1
    return least


@dataclass
class Model:
    """A filter and what scoring needs beside it."""

    filter: np.ndarray | None  # None if it is too large to broadcast
    parts_bits: int
    bits: int
    least: dict[int, int]
    tokens: int
    types: int
    known: np.ndarray  # hashes of the most frequent words, sorted
    known_counts: np.ndarray
    weights: np.ndarray  # of the bigram, by the level of the history

    def levels(self, grams: np.ndarray, kind: int) -> np.ndarray:
        return probed(self.filter, grams, self.least[kind], self.parts_bits, self.bits)

    def looked_up(self, tokens: np.ndarray, ends: np.ndarray,
                  found: dict[int, np.ndarray] | None = None) -> tuple[np.ndarray, ...]:
        """For each token: the word's share, its history's level, its bigram's level.

        ``found`` has the levels of the distinct words and bigrams in order of their hashes.
        """
        distinct, back = np.unique(tokens, return_inverse=True)
        pairs, of_pair = np.unique(bigrams(histories(tokens, ends), tokens), return_inverse=True)
        if found is None:
            found = {UNIGRAM: self.levels(distinct, UNIGRAM), BIGRAM: self.levels(pairs, BIGRAM)}
        level = found[UNIGRAM][back]
        history = np.roll(level, 1)
        # A text starts as often as one ends, and each ends with an end token.
        history[np.concatenate([[0], ends[:-1]])] = found[UNIGRAM][np.searchsorted(distinct, END)]
        share = (VALUES[level] + 1) / (self.tokens + self.types + 1)
        return share, history, found[BIGRAM][of_pair]

    def log_probabilities(self, tokens: np.ndarray, ends: np.ndarray,
                          found: dict[int, np.ndarray] | None = None) -> np.ndarray:
        share, history, pair = self.looked_up(tokens, ends, found)
        weight = self.weights[history]
        together = np.minimum(1.0, VALUES[pair] / np.maximum(VALUES[history], 1))
        return np.log10(weight * together + (1 - weight) * share)

    def exact(self, tokens: np.ndarray) -> np.ndarray:
        """Exact count of the most frequent words, -1 for others."""
        if not len(self.known):
            return np.full(len(tokens), -1)
        distinct, back = np.unique(tokens, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, distinct), len(self.known) - 1)
        return np.where(self.known[at] == distinct, self.known_counts[at], -1)[back]


def fit_weights(pieces: DataFrame, shared, read: Callable, held: Callable) -> np.ndarray:
    """For each level of the history the weight under which all training text is most likely,
    every token being left out of the counts of its own bigram and history.

    ``read`` gives what a batch of ``pieces`` holds, and ``held`` tells documents apart that
    are no training text.
    """

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((LEVELS + 1, len(WEIGHTS)))
        for batch in batches:
            for ids, _, tokens, ends, found in read(batch):
                learn = np.repeat([not held(i) for i in ids], np.diff(ends, prepend=0))
                share, history, pair = (x[learn] for x in shared.value.looked_up(tokens, ends, found))
                others = np.maximum(VALUES[pair] - 1, 0) * (pair > shared.value.least[BIGRAM])
                together = others / np.maximum(VALUES[history] - 1, 1)
                seen = np.flatnonzero(together > 0)
                missed = np.bincount(history[together == 0], minlength=LEVELS + 1)
                for g, weight in enumerate(WEIGHTS):
                    total[:, g] += missed * np.log(1 - weight)
                    gain = np.log(weight * together[seen] / share[seen] + 1 - weight)
                    total[:, g] += np.bincount(history[seen], weights=gain, minlength=LEVELS + 1)
        yield pa.RecordBatch.from_pydict({"level": pa.array(range(LEVELS + 1), pa.int32()),
                                          "gains": pa.array(total.tolist(), pa.list_(pa.float64()))})

    rows = pieces.mapInArrow(fit, "level int, gains array<double>")
    best = np.full(LEVELS + 1, WEIGHTS[0])
    by_level = rows.select("level", F.posexplode("gains").alias("g", "gain")).groupBy("level").pivot(
        "g", list(range(len(WEIGHTS)))).sum("gain")
    for row in by_level.collect():  # a row per level
        best[row.level] = WEIGHTS[int(np.argmax([row[str(g)] for g in range(len(WEIGHTS))]))]
    best[0] = 0.0  # after a word that is not stored there is no bigram
    return best


def read_texts(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(ids, keys, tokens, ends, None) of some texts at a time."""
    ids, keys = batch["doc_id"].to_pylist(), batch["key"].to_pylist()
    for rows, tokens, ends in slices(batch):
        yield [ids[k] for k in rows], [keys[k] for k in rows], tokens, ends, None


def read_found(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(ids, keys, tokens, ends, levels by kind) of one chunk at a time."""
    for k in range(batch.num_rows):
        row = {c: batch[c][k].as_py() for c in ("ids", "keys", "words", "places", "ends", "one", "two")}
        tokens, ends = unpacked(row["words"], row["places"], row["ends"])
        yield row["ids"], row["keys"], tokens, ends, {
            kind: np.frombuffer(b"".join(row[c]), np.uint8).astype(np.int64) for kind, c in ((UNIGRAM, "one"), (BIGRAM, "two"))}


def unpacked(distinct: bytes, places: bytes, ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.array(ends, dtype=np.int64)
    at = np.frombuffer(pa.decompress(places, 4 * int(ends[-1]), "zstd", asbytes=True), "<u4")
    return np.frombuffer(distinct, "<u8")[at], ends


def packed(hashes: np.ndarray) -> bytes:
    """Sorted hashes as the bytes of their differences, all first bytes first, compressed."""
    planes = np.diff(hashes, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    return len(hashes).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpacked_hashes(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def look_up(docs: DataFrame, model: Model, grams: DataFrame) -> DataFrame:
    """Chunks of the texts, with the levels of their words and bigrams: what a filter too large
    to broadcast gives.

    Each chunk asks once for each of its distinct n-grams, cut by part. A part's slice of the
    filter is made where the questions to it arrive, in several places if there are many, so
    a task holds one slice and about ASKED_BYTES of n-grams whatever the size of the corpus.
    """
    parts_bits, bits, least = model.parts_bits, model.bits, model.least
    shift = np.uint64(64 - parts_bits)
    places = 1 + (16 * model.tokens >> parts_bits) // ASKED_BYTES

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for ids, keys, tokens, ends, _ in read_texts(batch):
                distinct, at = np.unique(tokens, return_inverse=True)
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array([chunk], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int64())),
                    "keys": pa.array([keys], pa.list_(pa.int64())), "words": pa.array([distinct.tobytes()], pa.binary()),
                    "places": pa.array([pa.compress(at.astype("<u4").tobytes(), "zstd", asbytes=True)], pa.binary()),
                    "ends": pa.array([ends.tolist()], pa.list_(pa.int64()))})
                chunk += 1

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                chunk = batch["chunk"][k].as_py()
                tokens, ends = unpacked(*(batch[c][k].as_py() for c in ("words", "places", "ends")))
                for kind, hashes in ((UNIGRAM, tokens), (BIGRAM, bigrams(histories(tokens, ends), tokens))):
                    hashes = np.unique(hashes)
                    blocks = np.split(hashes, cut(hashes, shift))
                    yield pa.RecordBatch.from_pydict({
                        "chunk": pa.array([chunk] * len(blocks), pa.int64()),
                        "place": pa.array([chunk % places] * len(blocks), pa.int32()),
                        "kind": pa.array([kind] * len(blocks), pa.int32()),
                        "part": pa.array([int(h[0] >> shift) for h in blocks], pa.int32()),
                        "hashes": pa.array([packed(h) for h in blocks], pa.binary())})

    def answer(asked: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        there = fill_slice(zip(stored["kind"], stored["hashes"], stored["counts"]), least, parts_bits, bits)
        out = []
        for kind, rows in asked.groupby("kind"):
            hashes = [unpacked_hashes(h) for h in rows["hashes"]]
            level = probed(there, np.concatenate(hashes), least[kind], parts_bits, bits)
            cuts = np.cumsum([len(h) for h in hashes])[:-1]
            out.append(rows[["chunk", "kind", "part"]].assign(
                levels=[x.tobytes() for x in np.split(level.astype(np.uint8), cuts)]))
        return pd.concat(out) if out else asked[["chunk", "kind", "part"]].assign(levels=b"")

    chunks = stage(docs.mapInArrow(gather, CHUNKS), "chunks")
    asked = chunks.select("chunk", "words", "places", "ends").mapInArrow(
        ask, "chunk long, place int, kind int, part int, hashes binary")
    stored = grams.select("kind", "part", "hashes", "counts", F.explode(
        F.sequence(F.lit(0), F.lit(places - 1))).alias("place"))
    levels = asked.groupBy("part", "place").cogroup(stored.groupBy("part", "place")).applyInPandas(
        answer, "chunk long, kind int, part int, levels binary")

    def in_order(kind: int):
        return F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("part", "levels"))))["levels"]

    by_chunk = levels.groupBy("chunk").agg(in_order(UNIGRAM).alias("one"), in_order(BIGRAM).alias("two"))
    return stage(chunks.join(by_chunk, "chunk"), "found")


def prepare(docs: DataFrame, filter_bits: int | None, known_words: int) -> tuple[Model, DataFrame]:
    """(Model without weights, its counted n-grams) from the texts of ``docs``.

    With ``filter_bits`` None every counted n-gram is stored at its level, and a filter beyond
    the broadcast budget is not put together.
    """
    spark = docs.sparkSession
    parts_bits = part_bits(docs)
    grams = count_grams(docs, parts_bits)
    histogram = {k: np.zeros(LEVELS + 1, dtype=np.int64) for k in (UNIGRAM, BIGRAM)}
    for row in grams.select("kind", F.posexplode("histogram").alias("level", "n")).groupBy("kind", "level").agg(
            F.sum("n").alias("n")).collect():  # at most two rows per level
        histogram[row.kind][row.level] = row.n
    frequent = LEVELS
    while frequent > 0 and histogram[UNIGRAM][frequent:].sum() <= known_words:
        frequent -= 1
    known, known_counts = frequent_words(grams, frequent)
    sums = word_counts(grams).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    if filter_bits is None:
        least, bits = all_levels(), max(bits_needed(histogram, FILTER_BITS), parts_bits + 3)
    else:
        least, bits = least_levels(histogram, filter_bits), filter_bits
    small = filter_bits is not None or 1 << bits - 3 <= broadcast_budget(spark)
    return Model(build_filter(grams, least, parts_bits, bits) if small else None, parts_bits, bits, least, int(sums),
                 int(histogram[UNIGRAM].sum()), known, known_counts, np.full(LEVELS + 1, WEIGHTS[0])), grams


def fitted(pieces: DataFrame, model: Model, read: Callable, held: Callable):
    """The model with its weights, in a broadcast."""
    context = pieces.sparkSession.sparkContext
    first = context.broadcast(model)
    model.weights = fit_weights(pieces, first, read, held)
    first.unpersist()
    return context.broadcast(model)


def train(docs: DataFrame, filter_bits: int | None = None, known_words: int = KNOWN_WORDS):
    """(Model in a broadcast, its counted n-grams) from the texts of ``docs``."""
    docs = docs.select("doc_id", F.lit(0).cast("long").alias("key"), "text")
    model, grams = prepare(docs, filter_bits, known_words)
    pieces, read = (docs, read_texts) if model.filter is not None else (look_up(docs, model, grams), read_found)
    return fitted(pieces, model, read, lambda doc_id: False), grams


def frequent_words(grams: DataFrame, above: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the words above a level, gathered as one block per part."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hashes, counts in zip(batch["hashes"].to_pylist(), batch["counts"].to_pylist()):
                n = np.frombuffer(counts, "<i8")
                good = levels_of(n) > above
                yield pa.RecordBatch.from_pydict({
                    "hashes": pa.array([np.frombuffer(hashes, "<u8")[good].tobytes()], pa.binary()),
                    "counts": pa.array([n[good].tobytes()], pa.binary())})

    blocks = grams.where(F.col("kind") == UNIGRAM).select("hashes", "counts").mapInArrow(
        rows, "hashes binary, counts binary").collect()
    hashes = np.frombuffer(b"".join(b.hashes for b in blocks), "<u8")
    counts = np.frombuffer(b"".join(b.counts for b in blocks), "<i8")
    order = np.argsort(hashes)
    return hashes[order], counts[order]


def word_counts(grams: DataFrame) -> DataFrame:
    """(word hash, n, level), a row per distinct word."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hashes, counts in zip(batch["hashes"].to_pylist(), batch["counts"].to_pylist()):
                n = np.frombuffer(counts, "<i8")
                yield pa.RecordBatch.from_pydict({
                    "word": pa.array(np.frombuffer(hashes, "<i8")), "n": pa.array(n),
                    "level": pa.array(levels_of(n).astype(np.int32))})

    return grams.where(F.col("kind") == UNIGRAM).select("hashes", "counts").mapInArrow(
        rows, "word long, n long, level int")


def score(documents: DataFrame, folds: int = 7, held_fold: int = 2, filter_bits: int | None = None,
          known_words: int = KNOWN_WORDS) -> DataFrame:
    """Score every whole text by a model of the documents outside the held-out fold.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (unigrams with one
    added, exact counts), score (log10 probability by the filter). A null text counts as
    empty, that is one end token. A null doc_id is in no fold, so it is training text and
    not held out. Repeated rows count each for itself in training and get equal scores. An
    empty table gives no rows; without training text both scores are 0. Words are told apart
    by 64-bit hashes. Exact counts of the ``known_words`` most frequent words are broadcast;
    the documents meet those of all other words in a join. The filter grows with the n-grams
    and stores each of them at its level; only a caller that fixes its size by ``filter_bits`` gets
    a coarser model from a larger corpus. A very long text is hashed whole in its task, 8 bytes a
    word and some ten times that while it is scored.
    """
    doc_id = F.col("doc_id").cast("long")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = documents.select(doc_id.alias("doc_id"), text_key(doc_id, text).alias("key"), text.alias("text"))
    learnt = training(docs, folds, held_fold)
    model, grams = prepare(learnt, filter_bits, known_words)
    tokens, types = model.tokens, model.types

    def held(doc_id: int | None) -> bool:
        return remainder(doc_id, folds) == held_fold

    if model.filter is not None:
        pieces, read = docs, read_texts
        shared = fitted(learnt, model, read, held)
    else:
        pieces, read = look_up(docs, model, grams), read_found
        shared = fitted(pieces, model, read, held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for ids, keys, hashes, ends, found in read(batch):
                starts = np.concatenate([[0], ends[:-1]])
                exact = model.exact(hashes)
                common = exact >= 0
                base = np.add.reduceat(np.where(common, np.log10(np.maximum(exact, 0) + 1.0), 0.0), starts)
                rare = [counted(hashes[a:b][~common[a:b]]) for a, b in zip(starts, ends)]
                logs = model.log_probabilities(hashes, ends, found)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids, pa.int64()),
                    "key": pa.array(keys, pa.int64()),
                    "held_out": [held(i) for i in ids],
                    "n_tokens": pa.array(ends - starts),
                    "known": pa.array(np.add.reduceat(common.astype(np.int64), starts)),
                    "base": pa.array(base),
                    "score": pa.array(np.add.reduceat(logs, starts)),
                    "rare": pa.array([h.view(np.int64) for h, _ in rare], pa.list_(pa.int64())),
                    "times": pa.array([n.astype(np.int64) for _, n in rare], pa.list_(pa.int64()))})

    scored = stage(pieces.mapInArrow(run, SCORED), "scored")
    pairs = scored.where(F.size("rare") > 0).select("key", F.explode(F.arrays_zip("rare", "times")).alias("x"))
    # Repeated rows have one key and equal words.
    pairs = pairs.select("key", F.col("x.rare").alias("word"), F.col("x.times").alias("times")).distinct()
    found = pairs.join(word_counts(grams).select("word", "n"), "word")
    rare = found.groupBy("key").agg(F.sum("times").alias("rare_known"),
                                    F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("rare_base"))
    none = F.lit(0)
    return scored.join(rare, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", none)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))
         - F.col("n_tokens") * F.log10(F.lit(float(tokens + types + 1)))).alias("base_score"), "score")
