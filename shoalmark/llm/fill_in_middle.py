"""Fill-in-the-middle documents: cut at token boundaries that memoized chunks count.

A rolling hash cuts a text into chunks by its content, so that a passage which many texts share
gives the same chunks in all of them, wherever it lies. A chunk's summary is its number of tokens
and whether a letter stands at its two ends. Summaries of neighbours combine: a run of letters
that goes on over a boundary counts once. So a text's token count, and the chunk a cut falls
into, come from summaries, and only the chunks that hold a cut are read token by token.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalmark.llm.common import in_arrow

# Sentinels, shares of the forms in percent, and tokens (over UTF-8: a run of
# letters, or the first byte of any other character).
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = re.compile(b"<P>|<S>|<M>")
CUT_PERCENT, SPM_PERCENT = 90, 20
TOKEN = re.compile(rb"[A-Za-z]+|[^A-Za-z\x80-\xBF]")
LETTERS = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
FORMS = ("plain", "psm", "spm")

# The hash covers 32 bytes; a chunk has 2**CHUNK_BITS bytes on average between the limits.
WINDOW_DOUBLINGS = 5
CHUNK_BITS = 7
LEAST_CHUNK, MOST_CHUNK = 48, 1024
CACHE_BYTES = 16 * 1024 * 1024


def _gear() -> np.ndarray:
    return np.array([xxhash.xxh32_intdigest(bytes([byte])) for byte in range(256)], dtype=np.uint32)


def rolling_hashes(data: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """At each byte the sum of gear[byte] << age over the last 32 bytes, by doubling windows."""
    hashes = gear[data]
    for step in range(WINDOW_DOUBLINGS):
        width = 1 << step
        if len(hashes) > width:
            longer = hashes.copy()
            longer[width:] += hashes[:-width] << np.uint32(width)
            hashes = longer
    return hashes


def chunk_ends(text: bytes, gear: np.ndarray) -> list[int]:
    """Ends of the chunks of a text in UTF-8, each before the first byte of a character."""
    if len(text) <= LEAST_CHUNK:
        return [len(text)] if text else []
    data = np.frombuffer(text, dtype=np.uint8)
    chosen = rolling_hashes(data, gear)[:-1] >> np.uint32(32 - CHUNK_BITS) == 0
    wanted = (np.flatnonzero(chosen & (data[1:] & 0xC0 != 0x80)) + 1).tolist()
    ends, last = [], 0
    for end in [*wanted, len(text)]:
        while end - last > MOST_CHUNK:
            last += MOST_CHUNK
            while text[last] & 0xC0 == 0x80:
                last -= 1
            ends.append(last)
        if end - last >= LEAST_CHUNK or end == len(text):
            ends.append(end)
            last = end
    return ends


class Summary(NamedTuple):
    tokens: int
    letter_first: bool
    letter_last: bool


def summarise(chunk: bytes) -> Summary:
    return Summary(len(TOKEN.findall(chunk)), chunk[0] in LETTERS, chunk[-1] in LETTERS)


class ChunkCache:
    """Summaries by content, in bounded memory.

    A look-up compares the chunk's bytes, so another chunk of the same hash gets no wrong
    summary. The younger half takes new and used chunks; when it is full it becomes the older
    half, and what the older half held is forgotten.
    """

    def __init__(self, limit: int = CACHE_BYTES) -> None:
        self.limit, self.size = limit // 2, 0
        self.young: dict[bytes, Summary] = {}
        self.old: dict[bytes, Summary] = {}
        self.hits = self.misses = 0

    def summary(self, chunk: bytes) -> Summary:
        found = self.young.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        found = self.old.get(chunk)
        if found is None:
            self.misses += 1
            found = summarise(chunk)
        else:
            self.hits += 1
        if self.size > self.limit:
            self.old, self.young, self.size = self.young, {}, 0
        self.young[chunk] = found
        self.size += len(chunk)
        return found


class CountedText:
    """Token count of a text, and the place of any of its tokens, from its chunks' summaries."""

    def __init__(self, text: bytes, cache: ChunkCache, gear: np.ndarray) -> None:
        self.text = text
        self.ends = chunk_ends(text, gear)
        self.begins = [0, *self.ends[:-1]]
        starting, self.joined, letter = [], [], False
        for begin, end in zip(self.begins, self.ends):
            one = cache.summary(text[begin:end])
            self.joined.append(letter and one.letter_first)
            starting.append(one.tokens - self.joined[-1])
            letter = one.letter_last
        self.before = [0, *accumulate(starting)]

    def __len__(self) -> int:
        return self.before[-1]

    def start(self, token: int) -> int:
        """Byte at which a token starts; the end of the text for the token after the last."""
        if token >= len(self):
            return len(self.text)
        chunk = bisect_right(self.before, token) - 1
        inside = token - self.before[chunk] + self.joined[chunk]
        tokens = TOKEN.finditer(self.text, self.begins[chunk], self.ends[chunk])
        return next(islice(tokens, inside, None)).start()


def draws(doc_id: int | None, seed: int) -> Iterator[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return (int(digest[place:place + 8], 16) for place in range(0, 32, 8))


def rearrange(doc_id: int | None, text: bytes, cache: ChunkCache, gear: np.ndarray,
              seed: int) -> tuple[int, str, bytes | None, bytes | None, bytes]:
    """Token count, form, prefix and middle (None if plain) and output of one text."""
    counted = CountedText(text, cache, gear)
    n = len(counted)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= CUT_PERCENT or SENTINELS.search(text):
        return n, "plain", None, None, text
    low, high = sorted((counted.start(h1 % (n + 1)), counted.start(h2 % (n + 1))))
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h4 % 100 < SPM_PERCENT:
        return n, "spm", prefix, middle, b"<S>%b<P>%b<M>%b" % (suffix, prefix, middle)
    return n, "psm", prefix, middle, b"<P>%b<S>%b<M>%b" % (prefix, suffix, middle)


def transform(documents: DataFrame, seed: int = 1) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every whole text.

    A null or empty text has no tokens and is plain, as is a text that contains a sentinel. A
    null id draws as an empty one. Each row stands for itself, so repeated rows give equal rows
    and an empty table none; other columns are not read. A text of any length is cut into chunks
    of at most MOST_CHUNK bytes; its task holds the text, eight bytes of hashes for each of its
    bytes, its chunks' counts, and a cache of at most CACHE_BYTES.
    """
    state: list = []

    def rows(batch: pa.RecordBatch) -> dict:
        if not state:  # once in each task, so that all its batches share the cache
            state.extend([ChunkCache(), _gear()])
        out: dict[str, list] = {name: [] for name in ("n", "form", "prefix_chars", "middle_chars", "output")}
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            n, form, prefix, middle, output = rearrange(doc_id, data, *state, seed)
            out["n"].append(n)
            out["form"].append(form)
            out["prefix_chars"].append(None if prefix is None else len(prefix.decode()))
            out["middle_chars"].append(None if middle is None else len(middle.decode()))
            out["output"].append(output.decode())
        return {"doc_id": batch["doc_id"], **out}

    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return in_arrow(texts, rows, "doc_id long, n long, form string, prefix_chars long, "
                                 "middle_chars long, output string")


def restore(output: Column, form: Column) -> Column:
    """The text that gave ``output``, from output and form alone.

    Sentinels occur once each, as texts that contain one are plain.
    """
    def between(first: str, second: str) -> Column:
        return F.substring_index(F.substring_index(output, second, 1), first, -1)

    last = F.substring_index(output, MIDDLE, -1)
    return (F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), last, between(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(between(PREFIX, MIDDLE), last, between(SUFFIX, PREFIX)))
            .otherwise(output))
