"""Chat formatting with loss masks aligned by offsets.

A whole conversation is rendered, encoded once with offsets, and the sorted spans of the
turns to learn are intersected with the sorted token spans by binary search.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalmark.llm.common import in_arrow
from shoalmark.llm.tokenizer_files import encode_with_offsets

# The template: each turn is <turn ROLE>TEXT</turn> and a line end. Inside a role or a text
# a backslash stands before every backslash and angle bracket, so no marker can be forged
# and dropping those backslashes gives the text back.
OPEN, CLOSE = "<turn {}>", "</turn>\n"
TURN = re.compile(r"<turn ((?:[^\\<>]|\\.)*)>((?:[^\\<>]|\\.)*)</turn>\n", re.DOTALL)

CHATS = ("conv_id long, formatted string, ids array<int>, token_start array<int>, "
         "token_end array<int>, loss array<boolean>")
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
           "loss_sha256 string, formatted_chars long")


def escape(text: str) -> str:
    return re.sub(r"[\\<>]", r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(turns: list[tuple[str, str]], learn: str) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the sorted spans of the texts whose role is ``learn``."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = OPEN.format(escape(role)), escape(text)
        if role == learn:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, CLOSE)
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """Role and text of each turn, and where the text begins and ends in the formatted
    conversation; raises if any part of it is not a turn."""
    turns, at = [], 0
    while at < len(formatted):
        found = TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(found[1]), unescape(found[2]), *found.span(2)))
        at = found.end()
    return turns


def token_ranges(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """For each span the range of tokens that share a character with it; empty spans have none."""
    return [(int(np.searchsorted(ends, a, side="right")), int(np.searchsorted(starts, b, side="left")))
            if b > a else (0, 0) for a, b in spans]


def masked_text(formatted: str, texts: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray,
                loss: np.ndarray) -> str:
    """All characters under the mask, each once, but for markers in tokens that a text shares.

    Only where a masked token has a character of some turn's text can the markers in it be the
    template's doing. A masked token of markers alone, or over a text that is not to be learned,
    is a wrong mask, and its characters are there.
    """
    n = len(formatted)
    is_text = np.zeros(n + 1, dtype=np.int64)
    for begin, end in texts:
        is_text[begin] += 1
        is_text[end] -= 1
    is_text = np.cumsum(is_text)[:n] > 0
    before = np.concatenate([[0], np.cumsum(is_text)])

    def covered(tokens: np.ndarray) -> np.ndarray:
        change = np.bincount(starts[tokens], minlength=n + 1) - np.bincount(ends[tokens], minlength=n + 1)
        return np.cumsum(change)[:n] > 0

    shared = before[ends] > before[starts]
    under = covered(loss & shared) & is_text | covered(loss & ~shared)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], under.astype(np.int8), [0]])))
    return "".join(formatted[a:b] for a, b in edges.reshape(-1, 2).tolist())


def format_chats(conversations: DataFrame, tokenizer_path: str, learn: str = "assistant") -> DataFrame:
    """One row per conversation: text, token ids, token spans in characters, loss flags.

    ``loss`` is true for every token that shares a character with a text of the role
    ``learn``; the span of a token across a marker reaches beyond the text, so readers leave out
    the markers there. Turns go by (turn, role, text) with null turns first; null roles and texts count
    as empty; repeated rows are turns of their own; rows with a null conv_id form one
    conversation; an empty table gives no rows. A conversation is one training example, so
    its turns meet in one cell of one task: its texts must stay below 2 GB together, and the task
    needs some 60 times their size for tokens and offsets.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long"),
        F.struct(F.col("turn").cast("long").alias("turn"),
                 F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("turn"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))

    def rows(batch: pa.RecordBatch) -> dict:
        rendered = [render([(t["role"], t["text"]) for t in turns], learn)
                    for turns in batch["turns"].to_pylist()]
        out: dict = {name.split()[0]: [] for name in CHATS.split(", ")}
        out["conv_id"] = batch["conv_id"]
        for text, spans in rendered:
            ids, starts, ends = encode_with_offsets(text, tokenizer_path)
            loss = np.zeros(len(ids), dtype=bool)
            for low, high in token_ranges(starts, ends, spans):
                loss[low:high] = True
            for name, value in (("formatted", text), ("ids", ids), ("loss", loss),
                                ("token_start", starts), ("token_end", ends)):
                out[name].append(value)
        return out

    return in_arrow(whole, rows, CHATS)


def read_back(chats: DataFrame) -> DataFrame:
    """Digests of formatted conversations, from nothing but the output of ``format_chats``: the
    turns from the text, what is learned from the mask (``masked_text``)."""

    def rows(batch: pa.RecordBatch) -> dict:
        out: dict = {name.split()[0]: [] for name in DIGESTS.split(", ")}
        out["conv_id"] = batch["conv_id"]
        for k, text in enumerate(batch["formatted"].to_pylist()):
            turns = parse(text)
            starts, ends, loss = (batch[name][k].values.to_numpy(zero_copy_only=False)
                                  for name in ("token_start", "token_end", "loss"))
            under = masked_text(text, [turn[2:] for turn in turns], starts, ends, loss)
            learned = unescape(under)
            if escape(learned) != under:  # part of an escape is not under the mask, or a marker is
                learned = under
            said = "".join(f"{role}\n{body}\n" for role, body, _, _ in turns)
            for name, value in (("n_turns", len(turns)), ("loss_chars", len(learned)),
                                ("turns_sha256", hashlib.sha256(said.encode()).hexdigest()),
                                ("loss_sha256", hashlib.sha256(learned.encode()).hexdigest()),
                                ("formatted_chars", len(text))):
                out[name].append(value)
        return out

    return in_arrow(chats, rows, DIGESTS)
