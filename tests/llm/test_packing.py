import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from shoalmark.llm import packing
from shoalmark.llm.tokenizer_files import byte_level_encoder, with_offsets

PATH = public_tokenizers.path("byte_bpe_50k.json")


def fewest(items, capacity):
    """Brute force: the fewest bins, by placing each item into any open bin."""
    best = len(items)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(items):
            best = len(rooms)
            return
        for room in set(rooms):
            if room >= items[k]:
                rest = list(rooms)
                rest.remove(room)
                place(k + 1, [*rest, room - items[k]])
        place(k + 1, [*rooms, capacity - items[k]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(60))
def test_plan_places_each_piece_and_reduction_loses_nothing(seed):
    rng = random.Random(seed)
    low = rng.choice([1, 3, 6])
    items = sorted((rng.randint(low, 20) for _ in range(rng.randint(0, 9))), reverse=True)
    patterns = packing.plan(Counter(items), 20)
    placed = Counter()
    for pattern, times in patterns.items():
        assert sum(s * n for s, n in pattern) <= 20
        for s, n in pattern:
            placed[s] += n * times
    assert placed == Counter(items)
    fixed, rest = packing.reduce_by_dominance(Counter(items), 20)
    left = [s for s, n in rest.items() for _ in range(n)]
    assert sum(fixed.values()) + fewest(sorted(left, reverse=True), 20) == fewest(items, 20)


def test_large_histogram_is_near_the_bound():
    rng = random.Random(1)
    counts = Counter(min(1024, int(rng.lognormvariate(6, 1)) + 1) for _ in range(50_000))
    bins = sum(packing.plan(counts, 1024).values())
    assert bins <= 1.01 * -(-sum(s * n for s, n in counts.items()) // 1024) + 1


def test_encoder_equals_the_library():
    rng = random.Random(5)
    parts = ["a", "B", " ", "  ", "\n", "\t", " ", "é", "ß", "中文", "😀", "<|endoftext|>", "123",
             "'s", "\x00", "\x85", "İ", "\r\n", ".,!"]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert (with_offsets(PATH).encode(text, add_special_tokens=False).ids
                == byte_level_encoder(PATH).encode(text, allowed_special="all"))


def test_pack(frame):
    texts = ["", None, "the word " * 3000, "same text", "same text", "x" * 4000, "one two", None]
    texts += ["lorem ipsum dolor " * k for k in range(60)] + ["lorem ipsum dolor " * 20_000]
    docs = frame([(None if k == 7 else k // 2 * 2 if k in (3, 4) else k, t)
                  for k, t in enumerate(texts)], "doc_id long, text string")
    out = packing.pack(docs, PATH, with_ids=True).collect()
    encoder = byte_level_encoder(PATH)
    ids = sorted(tuple([*encoder.encode(t or "", allowed_special="all"), 2]) for t in texts)
    sizes = Counter()
    spans = {}
    for r in out:
        assert r.length <= 1024 and len(r.ids) == r.length
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        sizes[r.sequence_id] += r.length
        spans.setdefault(r.sequence_id, []).append((r.offset, r.offset + r.length))
    for places in spans.values():
        places.sort()
        assert places[0][0] == 0
        assert all(a[1] == b[0] for a, b in itertools.pairwise(places))
    assert max(sizes.values()) <= 1024
    whole = [r for r in out if r.start == 0]
    assert len(whole) == len(texts)
    by_doc = {}
    for r in sorted(out, key=lambda r: r.piece):
        if r.doc_id not in (2, 4, None) or r.doc_id == 2 and r.piece >= 0 and r.length > 500:
            by_doc.setdefault(r.doc_id, []).extend(r.ids)
    assert all(tuple(v) in ids for v in by_doc.values())
    total = sum(len(i) for i in ids)
    assert len(sizes) <= -(-total // 1024) + 1


def test_empty_table(frame):
    assert packing.pack(frame([], "doc_id long, text string"), PATH).collect() == []
