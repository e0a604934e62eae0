"""Exact BPE by backtracking over longest token matches.

An Aho-Corasick automaton finds every token in a word; the longest one at each place is
tried first. A split into tokens is what the merges would give exactly if each pair of
neighbours is (the pair alone would be merged to nothing else), so one table of compatible
pairs decides, and each place is left at most once for good. Decoding copies byte ranges
out of one buffer by an offset table.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalmark.llm.common import in_arrow
from shoalmark.llm.tokenizer_files import byte_alphabet, with_offsets

WORD_END = "\n"  # stands for the word-end suffix; no byte is written like this
KEPT_WORDS = 400_000
KEPT_PAIRS = 2_000_000
FOREVER = 1 << 30
NEW_LETTER = regex.compile(r"\p{Cn}")


class Pairs(dict):
    """Which tokens may stand side by side: pair to bool, worked out at first use."""

    def __init__(self, merges: dict[tuple[int, int], tuple[int, int]], parts: dict[int, tuple[int, int, int]]):
        self.merges, self.parts = merges, parts
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens that stood at this side (0 left, 1 right) of ``token`` while it was merged,
        each with the rank of the merge that ended it."""
        found = self.edges.get((token, side))
        if found is None:
            found, inner, until = [(token, FOREVER)], token, FOREVER
            while inner in self.parts:
                until, inner = self.parts[inner][2], self.parts[inner][side]
                found.append((inner, until))
            self.edges[token, side] = found
        return found

    def __missing__(self, pair: tuple[int, int]) -> bool:
        """No merge across the border comes before the merges that end its two tokens.

        Merges go by rank and, at one rank, from left to right: a merge of the same rank to
        the left of the border comes first, one to the right later.
        """
        fits = True
        for a, a_until in self.edge(pair[0], 1):
            for b, b_until in self.edge(pair[1], 0):
                merge = self.merges.get((a, b))
                if merge and merge[0] < a_until and merge[0] <= b_until:
                    fits = False
        if len(self) >= KEPT_PAIRS:
            self.clear()
        self[pair] = fits
        return fits


class WordBpe(dict):
    """Encoder and decoder for a ``tokenizers`` file of the word-end kind.

    As a dict it maps a word to its ids as little-endian 32-bit integers; words are encoded
    at first use and at most ``KEPT_WORDS`` are kept.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.path, self.known = path, set()
        model, vocab = spec["model"], spec["model"]["vocab"]
        suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = regex.compile("|".join(
            f"({regex.escape(s)})" for s in sorted(self.special, key=len, reverse=True)))
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern)
        self.letters = {b: c for c, b in byte_alphabet().items()}

        merges, parts, rank_of = {}, {}, {}
        for rank, (a, b) in enumerate(model["merges"]):
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            if max(rank_of.get(left, -1), rank_of.get(right, -1)) >= rank:
                raise ValueError("merges must come after the merges of their parts")
            merges[left, right] = rank, whole
            if whole not in parts:
                parts[whole], rank_of[whole] = (left, right, rank), rank
        self.pairs = Pairs(merges, parts)

        written = {}
        for token, i in vocab.items():
            if token not in self.special:
                ended = token.endswith(suffix) and token != suffix
                written[token.removesuffix(suffix) + WORD_END if ended else token] = i
        self.size = {i: len(token) for token, i in written.items()}
        self.automaton = ahocorasick.Automaton()
        self.shorter: dict[int, int | None] = {}
        for token, i in written.items():
            # A token that its own two parts would not be merged to never comes out.
            if i in parts and not self.pairs_merge(*parts[i]):
                continue
            self.automaton.add_word(token, (i, len(token)))
        self.automaton.make_automaton()
        for token, i in written.items():
            self.shorter[i] = next((written[token[:n]] for n in range(len(token) - 1, 0, -1)
                                    if token[:n] in self.automaton), None)

        texts = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in [*vocab.items(), *self.special.items()]:
            texts[i] = token
        pieces = [(t + " ").encode() for t in texts]  # decoding joins tokens with a space
        self.buffer = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])

    def pairs_merge(self, left: int, right: int, rank: int) -> bool:
        """Whether ``left`` and ``right`` get as far as being merged at ``rank``."""
        for a, a_until in self.pairs.edge(left, 1):
            for b, b_until in self.pairs.edge(right, 0):
                merge = self.pairs.merges.get((a, b))
                if (a, b) != (left, right) and merge and merge[0] < min(a_until, rank) \
                        and merge[0] <= min(b_until, rank):
                    return False
        return True

    def __missing__(self, word: str) -> bytes:
        symbols = "".join(map(self.letters.__getitem__, word.encode())) + WORD_END
        ids = np.array(self.tokens(symbols), dtype="<u4").tobytes()
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = ids
        return ids

    def tokens(self, symbols: str) -> list[int]:
        """The tokens of one word. Each place is proved a dead end at most once."""
        longest = {}
        for last, (token, length) in self.automaton.iter(symbols):
            longest[last + 1 - length] = token  # later matches from one place are longer
        size, shorter, pairs = self.size, self.shorter, self.pairs
        out: list[int] = []
        dead: set[int] = set()
        at, end, token = 0, len(symbols), longest.get(0)
        while at < end:
            if token is not None:
                after = at + size[token]
                if after in dead or (out and not pairs[out[-1], token]):
                    token = shorter[token]
                else:
                    out.append(token)
                    at, token = after, longest.get(after)
            else:  # nothing fits here: give back the last token and try a shorter one
                dead.add(at)
                if not out:
                    raise ValueError("a word that the vocabulary cannot write")
                token = out.pop()
                at -= size[token]
                token = shorter[token]
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers; special strings are their tokens."""
        if not any(s in text for s in self.special):
            return self.encode_plain(text)
        return b"".join(
            self.special[part].to_bytes(4, "little") if part in self.special else self.encode_plain(part)
            for part in self.split_special.split(text) if part)

    def encode_plain(self, text: str) -> bytes:
        """Composed, in lower case letter by letter (so no final sigma), cut into words.

        Letters newer than this Python's tables are left to the tokenizer file's own rules.
        """
        if not text.isascii():
            if not self.knows(text):
                return b"".join(map(self.__getitem__, self.library_words(text)))
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return b"".join(map(self.__getitem__, self.pieces.findall(text.lower())))

    def knows(self, text: str) -> bool:
        """Whether this Python's and the regex module's Unicode tables have all characters."""
        new = set(text).difference(self.known)
        if any(unicodedata.category(c) == "Cn" or NEW_LETTER.match(c) for c in new):
            return False
        self.known |= new
        return True

    def library_words(self, text: str) -> list[str]:
        library = with_offsets(self.path)
        written = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))
        bytes_of = {c: b for b, c in self.letters.items()}
        return [bytes(map(bytes_of.__getitem__, word)).decode() for word, _ in written]

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' text in UTF-8, joined by spaces as the vocabulary file's library does."""
        if not len(ids):
            return b""
        starts = self.offsets[ids]
        lengths = self.offsets[ids + 1] - starts
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)
        return self.buffer[places[:-1]].tobytes()


@functools.lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def encode(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, ids array<int>) of every document; see ``round_trip`` for special cases."""

    def rows(batch: pa.RecordBatch) -> dict:
        bpe = word_bpe(tokenizer_path)
        return {"doc_id": batch["doc_id"], "ids": [
            np.frombuffer(bpe.encode(text.as_py() or ""), dtype="<u4").astype(np.int32) for text in batch["text"]]}

    return in_arrow(_texts(documents), rows, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, decoded) of rows with token ids; null ids decode to an empty text."""

    def rows(batch: pa.RecordBatch) -> dict:
        bpe = word_bpe(tokenizer_path)
        return {"doc_id": batch["doc_id"], "decoded": [
            bpe.decode(np.array(ids.as_py() or [], dtype=np.int64)).decode() for ids in batch["ids"]]}

    return in_arrow(encoded.select("doc_id", "ids"), rows, "doc_id long, decoded string")


def round_trip(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """Encode every whole text, decode the ids, and return counts and digests of both.

    doc_id, n_tokens, ids_sha256 (of little-endian 32-bit ids), decoded_sha256 (of UTF-8).
    A null or empty text has no tokens and decodes to an empty text. Each row stands for
    itself, so repeated rows and null ids need no rule; an empty table gives no rows. A very long
    text is one row of its task and takes time in proportion to its length.
    """

    def rows(batch: pa.RecordBatch) -> dict:
        bpe = word_bpe(tokenizer_path)
        out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for text in batch["text"]:
            ids = bpe.encode(text.as_py() or "")
            out["n_tokens"].append(len(ids) // 4)
            out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
            decoded = bpe.decode(np.frombuffer(ids, dtype="<u4").astype(np.int64))
            out["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
        return {"doc_id": batch["doc_id"], **out}

    return in_arrow(_texts(documents), rows,
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
