"""Language identification by a linear-chain conditional random field over words.

Every word is labelled with a language, so code-switched text is told apart word by word. A
word's evidence is the weights of its prefixes, suffixes, letter n-grams and of the word
itself, hashed into one table; learned transitions link neighbours. Forward-backward gives
each word's posterior, and a document's language is the one with the largest expected share
of its words.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

from shoalmark.llm.common import remainder, remainder_column
from shoalmark.session import stage

UNDETERMINED = "und"
# The bounds of the sample that the model is fitted on, for each language.
SAMPLE_DOCUMENTS = 400
SAMPLE_LINES = 600
SAMPLE_CHARS = 2000  # of one line
TABLE_BITS = 18
GRAMS = (2, 3, 4)  # with the marks of a word's ends these hold affixes of up to three letters
MOST_LANGUAGES = 256  # more languages than these are an error: weights are kept for each
BATCH_WORDS = 60_000
BATCH_CELLS = 240_000  # of a table of chains, which all have the length of the longest
KEPT_WORDS = 150_000
ROUNDS, RATE, DECAY = 40, 0.5, 1e-5
WORD = re.compile(r"[^\W\d_]+")
PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"

_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
              dtype=np.uint64)
_LENGTH_SALT = np.arange(max(GRAMS), dtype=np.uint64) * _K[4]


def word_features(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids of all words one after the other, and where each word's begin.

    A feature is a hashed letter n-gram of the word between its end marks, or the whole word.
    """
    marked = [f"\x02{w}\x03" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) for w in marked])
    owner = np.repeat(np.arange(len(words)), lengths)
    within = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    ids, owners = [], []
    rolling = np.zeros(len(codes), dtype=np.uint64)
    for j in range(max(GRAMS)):
        last = len(codes) - j
        rolling = rolling[:last] + codes[j:] * _K[j]
        if j + 1 in GRAMS:
            inside = owner[:last] == owner[j:]
            ids.append(_slot(rolling[inside] + _LENGTH_SALT[j]))
            owners.append(owner[:last][inside])
    starts = np.cumsum(lengths) - lengths
    ids.append(_slot(np.add.reduceat(_mixed(codes * _K[0] + within.astype(np.uint64) * _K[1]), starts)))
    owners.append(np.arange(len(words)))
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(ids)[order], np.searchsorted(owners[order], np.arange(len(words)))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _K[2]
    return x ^ (x >> np.uint64(32))


def _slot(x: np.ndarray) -> np.ndarray:
    return (_mixed(x) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


@dataclass
class Chains:
    """Chains of word numbers as columns of a table, longest first; cells beyond an end are 0."""

    words: np.ndarray  # [position, chain]
    active: np.ndarray  # chains that reach each position
    owner: np.ndarray  # of each chain

    @staticmethod
    def of(chains: list[np.ndarray], owners: Sequence[int]) -> Chains:
        lengths = np.array([len(c) for c in chains])
        order = np.argsort(-lengths, kind="stable")
        table = np.zeros((int(lengths.max()), len(chains)), dtype=np.int64)
        for column, k in enumerate(order):
            table[:lengths[k], column] = chains[k]
        active = np.searchsorted(-lengths[order], -np.arange(len(table)), side="left")
        return Chains(table, active, np.asarray(owners)[order])


def posteriors(chains: Chains, emission: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each label in each cell, and the expected transitions in all chains.

    ``emission`` has each word's evidence and ``step`` the transitions, both as factors.
    """
    seen = emission[chains.words]
    forward = np.empty_like(seen)
    now = seen[0]
    for t, n in enumerate(chains.active):
        if t:
            now = (forward[t - 1, :n] @ step) * seen[t, :n]
        forward[t, :n] = now / now.sum(axis=1, keepdims=True)
    expected = np.zeros_like(step)
    after = np.ones_like(seen[0])
    for t in range(len(chains.active) - 1, -1, -1):
        n = chains.active[t]
        reach = chains.active[t + 1] if t + 1 < len(chains.active) else 0
        if reach:
            ahead = seen[t + 1, :reach] * after[:reach]
            back = ahead @ step.T
            scale = (forward[t, :reach] * back).sum(axis=1, keepdims=True)
            expected += step * (forward[t, :reach].T @ (ahead / scale))
            after[:reach] = back / back.sum(axis=1, keepdims=True)
        after[reach:n] = 1.0
        both = forward[t, :n] * after[:n]
        forward[t, :n] = both / both.sum(axis=1, keepdims=True)
        forward[t, n:] = 0.0
    return forward, expected


def factors(scores: np.ndarray) -> np.ndarray:
    return np.exp(scores - scores.max(axis=-1, keepdims=True))


class Labeller:
    """The fitted field. Words met before keep their evidence, up to ``KEPT_WORDS`` of them."""

    def __init__(self, languages: list[str], weights: np.ndarray, transitions: np.ndarray):
        self.languages, self.weights = languages, weights
        self.step = np.exp(transitions - transitions.max())
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.emission = np.zeros((0, len(self.languages)))

    def __reduce__(self):
        return _restored, (self.languages, self.weights, self.step)

    def numbers(self, lines: list[list[str]]) -> list[list[int]]:
        """A number for each word of each line; evidence for new words is worked out at once."""
        new = {w for line in lines for w in line if w not in self.number}
        if len(self.number) + len(new) > KEPT_WORDS:
            self.forget()
            new = {w for line in lines for w in line}
        if new:
            fresh = sorted(new)
            ids, starts = word_features(fresh)
            scores = factors(np.add.reduceat(self.weights[ids], starts, axis=0))
            self.number.update(zip(fresh, range(len(self.emission), len(self.emission) + len(fresh))))
            self.emission = np.concatenate([self.emission, np.maximum(scores, 1e-30)])
        return [[self.number[w] for w in line] for line in lines]

    def shares(self, texts: Iterable[str], count: int) -> np.ndarray:
        """Expected words of each language in each of ``count`` texts, taken one by one."""
        out = np.zeros((count, len(self.languages)))
        lines, owners, size = [], [], 0
        for k, text in enumerate(texts):
            for line in text.lower().split("\n"):
                found = [w for w in WORD.findall(line) if w.isalpha() or any(map(str.isalpha, w))]
                if found:
                    lines.append(found)
                    owners.append(k)
                    size += len(found)
                if size >= BATCH_WORDS:
                    self._add(lines, owners, out)
                    lines, owners, size = [], [], 0
        if lines:
            self._add(lines, owners, out)
        return out

    def _add(self, lines: list[list[str]], owners: list[int], out: np.ndarray) -> None:
        """Lines of like length go through the field together, each as one chain."""
        numbers = self.numbers(lines)
        order = sorted(range(len(lines)), key=lambda i: -len(lines[i]))
        while order:
            many = max(1, BATCH_CELLS // len(lines[order[0]]))
            some, order = order[:many], order[many:]
            chains = Chains.of([np.array(numbers[i]) for i in some], [owners[i] for i in some])
            share, _ = posteriors(chains, self.emission, self.step)
            np.add.at(out, chains.owner, share.sum(axis=0))


def _restored(languages: list[str], weights: np.ndarray, step: np.ndarray) -> Labeller:
    return Labeller(languages, weights, np.log(step))


def fit(lines: list[tuple[str, str]]) -> Labeller | None:
    """Fit the field to (text, language) lines by gradient ascent on the conditional likelihood."""
    lines = [(WORD.findall(text.lower()), language) for text, language in lines]
    lines = [(words, language) for words, language in lines if words]
    if not lines:
        return None
    languages = sorted({language for _, language in lines})
    vocabulary = sorted({w for words, _ in lines for w in words})
    number = {w: i for i, w in enumerate(vocabulary)}
    ids, starts = word_features(vocabulary)
    per_word = np.diff(np.append(starts, len(ids)))
    chains = Chains.of([np.array([number[w] for w in words]) for words, _ in lines],
                       [languages.index(language) for _, language in lines])
    inside = np.arange(chains.words.shape[1]) < chains.active[:, None]
    truth = np.eye(len(languages))[chains.owner][None] * inside[:, :, None]
    pairs = np.maximum(inside[1:].sum(axis=0), 0)
    told = np.zeros((len(languages),) * 2)
    np.add.at(told, (chains.owner, chains.owner), pairs)

    used, place = np.unique(ids, return_inverse=True)
    weights, step = np.zeros((len(used), len(languages))), np.zeros_like(told)
    weights_seen, step_seen = np.full_like(weights, 1e-6), np.full_like(step, 1e-6)
    cells, tokens = chains.words[inside], float(inside.sum())
    for _ in range(ROUNDS):
        emission = np.maximum(factors(np.add.reduceat(weights[place], starts, axis=0)), 1e-30)
        share, expected = posteriors(chains, emission, np.exp(step - step.max()))
        by_word = np.zeros((len(vocabulary), len(languages)))
        np.add.at(by_word, cells, (truth - share)[inside])
        gradient = np.zeros_like(weights)
        np.add.at(gradient, place, np.repeat(by_word, per_word, axis=0))
        gradient = gradient / tokens - DECAY * weights
        weights_seen += gradient ** 2
        weights += RATE * gradient / np.sqrt(weights_seen)
        gradient = (told - expected) / tokens - DECAY * step
        step_seen += gradient ** 2
        step += RATE * gradient / np.sqrt(step_seen)
    table = np.zeros((1 << TABLE_BITS, len(languages)), dtype=np.float32)
    table[used] = weights
    return Labeller(languages, table, step)


def sample_lines(documents: DataFrame) -> list[tuple[str, str]]:
    """(line, lang) of a bounded sample: lines of documents chosen by a hash, for each language.

    Documents are counted first, so that about one and a half times the sample leaves the
    scan, whatever the size of the table. More than MOST_LANGUAGES languages raise.
    """
    labelled = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = stage(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("__n")), "languages")
    if counts.count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} different values of lang")
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = labelled.join(F.broadcast(counts), "lang").withColumn("__draw", draw).where(
        F.col("__draw") * F.col("__n") < 1.5 * SAMPLE_DOCUMENTS)
    docs = drawn.withColumn("__rank", F.row_number().over(Window.partitionBy("lang").orderBy("__draw", "text"))) \
        .where(F.col("__rank") <= SAMPLE_DOCUMENTS)
    lines = docs.select("lang", F.explode(F.split("text", "\n", -1)).alias("line")).select(
        "lang", F.substring("line", 1, SAMPLE_CHARS).alias("line")).where(F.col("line").rlike(r"\p{L}"))
    ranked = lines.withColumn("__rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.xxhash64("line"), "line"))).where(F.col("__rank") <= SAMPLE_LINES)
    # At most SAMPLE_LINES rows of SAMPLE_CHARS characters for each language.
    return sorted((r.line, r.lang) for r in ranked.select("line", "lang").collect())


def train(documents: DataFrame, folds: int = 4, held_fold: int = 2) -> Labeller | None:
    """Fit on documents outside the held-out fold; None if none of them has a language and a word."""
    fold = remainder_column("doc_id", folds)
    learn = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    return fit(sample_lines(learn.where(fold.isNull() | (fold != held_fold))))


def judged(labeller: Labeller | None, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and share of each text; ``und`` and 0 for a text that is null or has no letter,
    or for any text if nothing could be learned. Ties go to the first language by name."""
    if labeller is None:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    shares = labeller.shares((t.as_py() or "" for t in texts), len(texts))
    total, top = shares.sum(axis=1), shares.argmax(axis=1)
    best = [labeller.languages[t] if n > 0 else UNDETERMINED for t, n in zip(top, total)]
    return best, np.minimum(1.0, shares.max(axis=1) / np.where(total > 0, total, 1.0))


def predict(documents: DataFrame, labeller: Labeller | None, folds: int = 4, held_fold: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every whole text, from the text alone.

    ``score`` is the expected share of words in the predicted language; see ``judged`` for
    texts without one. A null doc_id is not held out. Each row stands for itself, so repeated
    rows get the same result; an empty table gives no rows. Every line is one chain, however
    long; a line takes 100 bytes a word for each four languages while it is worked on.
    """
    shared = documents.sparkSession.sparkContext.broadcast(labeller)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = judged(shared.value, batch["text"])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"],
                "held_out": [remainder(i, folds) == held_fold for i in batch["doc_id"].to_pylist()],
                "lang_pred": pa.array(best, pa.string()), "score": pa.array(score, pa.float64())})

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PREDICTED)


def mark(documents: DataFrame, labeller: Labeller | None) -> DataFrame:
    """All columns of ``documents`` with lang_pred and lang_share, which replace columns of
    those names. Rows, repeated ones too, keep their order and their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(labeller)
    own = documents.drop("lang_pred", "lang_share")
    schema = StructType([*own.schema.fields, StructField("lang_pred", StringType()), StructField("lang_share", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, share = judged(shared.value, batch["text"])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(best, pa.string()), pa.array(share, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "lang_share"])

    return own.mapInArrow(run, schema)
