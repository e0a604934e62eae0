import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from shoalmark.llm import lm
from shoalmark.llm.common import words


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocab = [f"W{i}" for i in range(60)]
    phrases = [" ".join(rng.choice(vocab) for _ in range(8)) for _ in range(6)]
    texts = [None, "", "A a\x0bÉ\x85x", "one " * 30_000]
    for _ in range(n):
        texts.append(" ".join(rng.choice(phrases) if rng.random() < 0.4 else rng.choice(vocab) if rng.random() < 0.9
                              else f"x{rng.random()}" for _ in range(rng.randint(1, 20))))
    rows = [(None if i == 6 else i, t) for i, t in enumerate(texts)]
    return [*rows, rows[10], rows[10]]


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        if not held(doc_id):
            counts.update([*words(text), None])
    total, types = sum(counts.values()), len(counts)
    out = []
    for doc_id, text in rows:
        tokens = [*words(text), None]
        out.append((doc_id, held(doc_id), len(tokens), sum(counts[t] > 0 for t in tokens), total,
                    sum(math.log10((counts[t] + 1) / (total + types + 1)) for t in tokens)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("known", [1 << 20, 20, 0])
def test_base_equals_brute_force(frame, known):
    rows = corpus(1)
    found = lm.score(frame(rows, "doc_id long, text string"), known_words=known, filter_bits=20).collect()
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=repr)
    want = brute(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-10)
    by_id = {r.doc_id: r.score for r in found}
    assert all(math.isfinite(s) and s <= 0 for s in by_id.values())
    held_out = [r for r in found if r.held_out and r.n_tokens < 1000]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)


def test_score_equals_quantised_counts(spark, frame):
    """With a filter large enough for no false hit, scores follow from the exact counts."""
    rows = corpus(2, 60)
    df = frame(rows, "doc_id long, text string")
    train = [(d, t) for d, t in rows if not held(d)]
    shared, _ = lm.train(lm.training(df.select("doc_id", "text"), 7, 2), filter_bits=26)
    model = shared.value
    one, two = Counter(), Counter()
    for _, text in train:
        tokens = ["<s>", *words(text), "</s>"]
        one.update(tokens[1:])
        two.update(zip(tokens, tokens[1:]))
    one["<s>"] = one["</s>"]
    value = lambda n: lm.VALUES[lm.levels_of(np.array([n]))[0]]
    found = {r.doc_id: r.score for r in lm.score(df, filter_bits=26).collect()}
    for doc_id, text in rows:
        total, tokens = 0.0, ["<s>", *words(text), "</s>"]
        for h, w in zip(tokens, tokens[1:]):
            share = (value(one[w]) + 1) / (model.tokens + model.types + 1)
            pair = two[h, w]
            weight = model.weights[lm.levels_of(np.array([one[h]]))[0]]
            total += math.log10(weight * min(1, value(pair) / max(value(one[h]), 1)) + (1 - weight) * share)
        assert found[doc_id] == pytest.approx(total, rel=1e-9)


def test_filter_returns_levels():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2))
    counts = rng.integers(1, 4000, len(hashes))
    levels = lm.levels_of(counts)
    bits = np.zeros(1 << 22, dtype=bool)
    for j in range(1, levels.max() + 1):
        for probe in range(lm.PROBES):
            bits[lm.positions(hashes[levels >= j], j, probe, 6, 22).astype(np.int64)] = True
    model = lm.Model(np.packbits(bits, bitorder="little"), 6, 22, {0: 1, 1: 2}, 1, 1, None, None, None)
    found = model.levels(hashes, lm.UNIGRAM)
    assert (found >= levels).all() and (found == levels).mean() > 0.99
    assert (model.levels(lm.mixed(hashes), lm.UNIGRAM) > 0).mean() < 0.02
    assert (lm.VALUES[lm.levels_of(np.arange(1, 4))] == [1, 2, 3]).all()


def test_small_filter_keeps_to_its_size():
    histogram = {0: np.full(lm.LEVELS + 1, 10_000), 1: np.full(lm.LEVELS + 1, 90_000)}
    least = lm.least_levels(histogram, 20)
    load = sum((histogram[k] * np.arange(lm.LEVELS + 1))[least[k]:].sum() for k in (0, 1)) * lm.PROBES
    assert load <= 0.69 * (1 << 20)


def test_empty(frame):
    assert lm.score(frame([], "doc_id long, text string"), filter_bits=16).collect() == []
    held_only = frame([(2, "a b")] if held(2) else [(next(i for i in range(99) if held(i)), "a b")], "doc_id long, text string")
    assert [(r.n_known, r.base_score, r.score) for r in lm.score(held_only, filter_bits=16).collect()] == [(0, 0.0, 0.0)]


def test_filter_grows_until_all_is_stored():
    histogram = {0: np.full(lm.LEVELS + 1, 10_000), 1: np.full(lm.LEVELS + 1, 90_000)}
    bits = lm.bits_needed(histogram, 20)
    load = sum(lm.stored_load(histogram, lm.all_levels()).values())
    assert 0.345 * (1 << bits) < load <= 0.69 * (1 << bits)
    assert lm.least_levels(histogram, bits) == lm.all_levels()


def test_no_level_is_given_up_and_slices_score_alike(spark, frame, monkeypatch):
    """More n-grams than the least filter holds: all are stored, broadcast or in slices."""
    df = frame(corpus(3, 300), "doc_id long, text string")
    monkeypatch.setattr(lm, "FILTER_BITS", 12)
    monkeypatch.setattr(lm, "SCORE_SLICE", 500)  # many chunks
    scores = lambda: sorted((repr(r.doc_id), r.score, r.base_score, r.n_known) for r in lm.score(df).collect())
    docs = df.select("doc_id", "text")
    whole = scores()
    model = lm.train(docs)[0].value
    assert model.least == lm.all_levels() and model.bits > 12
    spark.conf.set("spark.shoalmark.broadcastBytes", "1")
    try:
        monkeypatch.setattr(lm, "ASKED_BYTES", 64)  # several places a slice
        assert lm.train(docs)[0].value.filter is None
        assert scores() == whole
    finally:
        spark.conf.unset("spark.shoalmark.broadcastBytes")
