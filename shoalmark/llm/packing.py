"""Best-fit packing of token pieces after a dominance reduction.

Spark tokenises, counts the pieces of each length, ranks them and deals them out. The
combinatorial part sees nothing but that histogram, which has at most ``capacity`` entries
whatever the size of the corpus.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoalmark.llm.common import in_arrow
from shoalmark.llm.tokenizer_files import byte_level_encoder
from shoalmark.session import stage

Pattern = tuple[tuple[int, int], ...]  # (length, copies) of one sequence

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"


def cut(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else full pieces after the rest."""
    first = n_tokens % capacity or min(n_tokens, capacity)
    starts = [0, *range(first, n_tokens, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n_tokens])]


def token_pieces(documents: DataFrame, tokenizer_path: str, capacity: int, end_id: int,
                 with_ids: bool = False) -> DataFrame:
    """Pieces of every document's token ids, its end id included. Null text counts as empty."""

    def rows(batch: pa.RecordBatch) -> dict:
        encoder = byte_level_encoder(tokenizer_path)
        out: dict[str, list] = {name.split()[0]: [] for name in PIECES.split(", ")}
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            ids = encoder.encode_to_numpy(text.as_py() or "", allowed_special="all")
            ids = np.append(ids, end_id).astype("<u4")
            for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                part = ids[start:start + length]
                for name, value in zip(out, (doc_id, piece, start, length,
                                             zlib.crc32(part.tobytes()),
                                             part.astype("i4") if with_ids else None)):
                    out[name].append(value)
        return out

    docs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return in_arrow(docs, rows, PIECES)


def _fits_beside(counts: dict[int, int], room: int, most: int) -> int:
    """How many of the smallest pieces fit into ``room``, counted up to ``most``."""
    n = 0
    for size in sorted(counts):
        here = min(counts[size], room // size, most - n)
        n, room = n + here, room - here * size
        if n == most or here < counts[size]:
            break
    return n


def _largest(counts: dict[int, int], room: int) -> int:
    return max((s for s, n in counts.items() if n > 0 and s <= room), default=0)


def _dominating(counts: dict[int, int], size: int, capacity: int) -> tuple[int, ...] | None:
    """A set with ``size`` that dominates all others with it, or None if that isn't provable.

    With room r beside the piece: (1) a partner of exactly r can stand for anything else in
    r; (2) if at most one more piece fits, the largest that fits; (3) if at most two fit, the
    largest single that is no shorter than any pair, or the pair whose parts are each
    no shorter than the parts of any other.
    """
    room = capacity - size
    others = {**counts, size: counts[size] - 1}
    others = {s: n for s, n in others.items() if n > 0}
    if others.get(room):
        return (room,)
    beside = _fits_beside(others, room, 3)
    if beside == 0:
        return ()
    single = _largest(others, room)
    if beside == 1:
        return (single,)
    if beside == 2:
        without = {**others, single: others[single] - 1}
        second = _largest(without, room - single)
        firsts = [s for s in others if s <= room]
        pair = max((s + _largest({**others, s: others[s] - 1}, room - s) for s in firsts
                    if _largest({**others, s: others[s] - 1}, room - s)), default=0)
        if single >= pair:
            return (single,)
        if second and second >= _largest(without, room // 2):
            return (single, second)
    return None


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[Counter[Pattern], dict[int, int]]:
    """Sequences that some best packing has, and the pieces left over.

    Passes from long to short pieces until one fixes nothing more; every set fixed shrinks
    the instance, which can make further sets provable.
    """
    counts = {s: n for s, n in counts.items() if n > 0}
    fixed: Counter[Pattern] = Counter()
    changed = True
    while changed:
        changed = False
        for size in sorted(counts, reverse=True):
            while counts.get(size):
                partners = _dominating(counts, size, capacity)
                if partners is None:
                    break
                pattern = Counter((size, *partners))
                times = min(counts[s] // n for s, n in pattern.items())
                if len(partners) == 2:
                    times = 1  # the pair rule is proved anew each time
                fixed[tuple(sorted(pattern.items(), reverse=True))] += times
                for s, n in pattern.items():
                    counts[s] -= n * times
                    if not counts[s]:
                        del counts[s]
                changed = True
    return fixed, counts


def best_fit(counts: dict[int, int], capacity: int) -> Counter[Pattern]:
    """Best fit from long to short over the histogram: equal sequences are filled together."""
    open_by_room: dict[int, Counter[Pattern]] = {}
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = min((r for r in open_by_room if r >= size), default=None)
            if room is None:
                pattern, bins, room = (), left, capacity
            else:
                pattern, bins = open_by_room[room].popitem()
            each = min(room // size, left)
            filled = min(bins, left // each)
            if pattern or filled < bins:
                if bins - filled and pattern:
                    open_by_room[room][pattern] += bins - filled
                if pattern and not open_by_room[room]:
                    del open_by_room[room]
            rest = room - each * size
            open_by_room.setdefault(rest, Counter())[(*pattern, (size, each))] += filled
            left -= each * filled
    done: Counter[Pattern] = Counter()
    for patterns in open_by_room.values():
        done.update(patterns)
    return done


def plan(counts: dict[int, int], capacity: int) -> Counter[Pattern]:
    """Sequences for a histogram of lengths: dominance first, best fit for the remainder."""
    fixed, rest = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def runs(patterns: Counter[Pattern]) -> np.ndarray:
    """Rows (length, first rank, first sequence, copies in a sequence, offset), in order.

    Pieces of one length take the places in order of their rank, so a run says where a
    whole range of ranks goes.
    """
    taken: Counter[int] = Counter()
    out, sequence = [], 0
    for pattern, times in sorted(patterns.items(), reverse=True):
        offset = 0
        for size, copies in pattern:
            out.append((size, taken[size], sequence, copies, offset))
            taken[size] += copies * times
            offset += size * copies
        sequence += times
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 5)


def pack(documents: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2,
         with_ids: bool = False) -> DataFrame:
    """Pack all documents into as few sequences of at most ``capacity`` tokens as it can.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset
    (and ids, if asked for). Every input row is packed: repeated rows and ids are packed
    each for itself, a null or empty text is its end id alone, a null doc_id stays null, an
    empty table gives no rows. Only doc_id and text are read, so other columns don't clash. A very
    long text is encoded whole in its task and leaves it in pieces.
    """
    pieces = token_pieces(documents, tokenizer_path, capacity, end_id, with_ids)
    pieces = stage(pieces.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    pieces = pieces.withColumn("__part", F.shiftright("__row", 33))
    # One row for each length, so at most ``capacity`` rows.
    histogram = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    places = runs(plan(histogram, capacity))

    by_length = Window.partitionBy("length").orderBy("__part")
    before = (pieces.groupBy("length", "__part").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("__before", F.sum("n").over(by_length) - F.col("n")).drop("n"))
    in_part = Window.partitionBy("length", "__part").orderBy("__row")
    ranked = (pieces.withColumn("__in_part", F.row_number().over(in_part) - 1)
              .join(before, ["length", "__part"])
              .withColumn("rank", F.col("__before") + F.col("__in_part")))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def rows(batch: pa.RecordBatch) -> dict:
        length = batch["length"].to_numpy(zero_copy_only=False)
        rank = batch["rank"].to_numpy(zero_copy_only=False)
        wide = np.int64(1) << 48
        run = places[np.searchsorted(places[:, 0] * wide + places[:, 1],
                                     length * wide + rank, side="right") - 1]
        nth = rank - run[:, 1]
        return {**{c: batch[c] for c in kept}, "sequence_id": run[:, 2] + nth // run[:, 3],
                "offset": run[:, 4] + nth % run[:, 3] * length}

    schema = PIECES if with_ids else PIECES.removesuffix(", ids array<int>")
    return in_arrow(ranked.select(*kept, "rank"), rows, f"{schema}, sequence_id long, offset long")
