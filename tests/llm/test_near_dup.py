import functools
import random
import time

import numpy as np
import pytest
from shoalmark.llm import near_dup
from shoalmark.llm.common import words


def aligned(a, b):
    """Longest common subsequence of the shingles, by the full table."""
    sa, sb = (list(dict.fromkeys(tuple(x[i:i + 5]) for i in range(len(x) - 4))) for x in (a, b))
    row = [0] * (len(sb) + 1)
    for x in sa:
        above = row[:]
        for j, y in enumerate(sb, 1):
            row[j] = above[j - 1] + 1 if x == y else max(above[j], row[j - 1])
    return row[-1], len(sa) + len(sb)


def linked(a, b):
    if a == b:
        return bool(a)
    matched, total = aligned(a, b)
    return total > 0 and matched > 0 and matched >= 0.8 * (total - matched)


def edited(rng, tokens, times):
    out = list(tokens)
    for _ in range(times):
        at = rng.randrange(len(out))
        what = rng.random()
        if what < 0.5:
            out[at] = f"new{rng.random()}"
        elif what < 0.75:
            del out[at]
        else:
            out.insert(at, f"new{rng.random()}")
    return out


def test_similar_equals_full_table():
    rng = random.Random(1)
    seen = set()
    for _ in range(400):
        a = [f"w{rng.randint(0, rng.choice([3, 400]))}" for _ in range(rng.randint(0, 90))]
        b = edited(rng, a, rng.randint(0, 6)) if a else []
        if rng.random() < 0.2:
            b = b[len(b) // 2:] + b[:len(b) // 2]
        a, b = ([x.encode() for x in t] for t in (a, b))
        assert near_dup.similar(a, b) == (a == b or linked(a, b))
        seen.add(near_dup.similar(a, b))
    assert seen == {True, False}


def corpus(seed):
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randint(0, 4000)}" for _ in range(n)]
    passage, hub, texts = fresh(40), fresh(150), [None, "", " \n", "one two", "One  two", "one two three"]
    for _ in range(60):
        texts.append(" ".join(fresh(rng.randint(5, 200))))
        texts.append(" ".join([*fresh(60), *passage, *fresh(20)]))
    for _ in range(60):
        texts.append(" ".join(edited(rng, hub, rng.randint(0, 6))))
    for base in list(texts[10:40]):
        texts.append(" ".join(edited(rng, base.split(), rng.randint(0, 4))).upper())
        texts.append(base)
    line = " ".join(fresh(30))
    texts += [" ".join([line] * k + fresh(25)) for k in (1, 4, 9, 9, 12)]
    texts += [" ".join([line] * k + hub[:90]) for k in (1, 5)]
    texts.append("again and " * 30_000)
    texts.append("again and " * 30_001)
    rng.shuffle(texts)
    return [(None if i in (7, 8) else i, t) for i, t in enumerate(texts)] + [(3, texts[3])]


def classes(rows):
    tokens = [words(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            long = min(len(tokens[i]), len(tokens[j])) > 1000
            sizes = sorted(len({tuple(x[k:k + 5]) for k in range(len(x) - 4)}) for x in (tokens[i], tokens[j]))
            if long and near_dup.similar(tokens[i], tokens[j]) or not long and (
                    tokens[i] == tokens[j] or sizes[0] >= 0.8 * sizes[1]) and tokens[i] and linked(tokens[i], tokens[j]):
                root[find(i)] = find(j)
    return {frozenset(k for k in range(len(rows)) if find(k) == r) for r in set(map(find, range(len(rows))))}


@pytest.fixture(params=[1, 2])
def case(request, frame):
    rows, expected = truth(request.param)
    return rows, frame(rows, "doc_id long, text string"), expected


@functools.cache
def truth(seed):
    rows = corpus(seed)
    return rows, classes(rows)


def check(rows, df, expected):
    by_row = {}
    for r in near_dup.near_duplicates(df).collect():
        by_row.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, by_row.values())) == len(rows)
    for group in expected:
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        if words(rows[min(group)][1]) and ids:
            for d in ids:
                assert {(r.class_id, r.class_size) for r in by_row[d]} == {(min(ids), len(group))}
        elif ids:
            assert {r.class_id for d in ids for r in by_row[d]} == set(ids)


def test_classes(case):
    check(*case)


def test_without_broadcast_and_with_small_blocks(case, no_broadcast, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", 3)
    check(*case)


def test_keep_one(case):
    rows, df, expected = case
    kept = near_dup.keep_one(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    wordless = {d for d, t in rows if not words(t)}
    want = sorted(min((rows[k][0] for k in g if rows[k][0] is not None), default=-1) for g in expected)
    assert sorted(-1 if i is None else i for i in ids if i not in wordless) == [
        w for w in want if w not in wordless]
    assert wordless <= set(ids)


def test_empty(frame):
    df = frame([], "doc_id long, text string")
    assert near_dup.near_duplicates(df).collect() == []
    assert near_dup.keep_one(df).collect() == []


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(50)]
    found = {r.node: r.root for r in near_dup.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(200):
        for u, v in edges:
            if u != v:
                root[u] = root[v] = min(root[u], root[v])
    assert found == root


def test_order_matters():
    tokens = [f"w{i}".encode() for i in range(300)]
    swapped = tokens[150:] + tokens[:150]
    a, b = (near_dup.order_sketches(*near_dup.occurrences(near_dup.shingle_hashes(t))) for t in (tokens, swapped))
    assert (a == b).sum() < 16


def test_signatures_pass_what_is_similar_and_little_else():
    rng = random.Random(9)
    for n in (6, 40, 300, 3000):
        kept = {True: [], False: []}
        for edits in range(0, max(2, n // 12)):
            a = [f"w{rng.random()}".encode() for _ in range(n)]
            b = [x.encode() for x in edited(rng, [x.decode() for x in a], edits)]
            sa, sb = near_dup.shingle_hashes(a), near_dup.shingle_hashes(b)
            if len(sa) and len(sb):
                words_of = near_dup.signature_words([near_dup.signature(sa), near_dup.signature(sb)])
                passes = near_dup.close(words_of[0], words_of[1:], np.array([len(sa) + len(sb)]))[0]
                shared = len(set(sa.tolist()) & set(sb.tolist()))
                kept[near_dup.similar(a, b)].append((passes, shared / (len(sa) + len(sb) - shared)))
        assert all(p for p, _ in kept[True])
        assert not any(p for p, j in kept[False] if j < 0.72)


@pytest.mark.parametrize("total", [400, 2000, 8000])
def test_signatures_five_deviations_apart_pass(total):
    m, d = near_dup.SIGNATURE_BITS, total * 0.2 / 1.8
    mean = m / 2 * (1 - np.exp(-2 * d / m))
    variance = m / 4 * (1 - np.exp(-4 * d / m)) - d * np.exp(-4 * d / m)
    bits = np.arange(m) < mean + 5.5 * np.sqrt(variance)
    apart = np.packbits(bits).view(np.uint64)
    assert near_dup.close(np.zeros_like(apart), apart[None], np.array([total]))[0]


def test_long_texts_are_aligned_in_n_log_n():
    rng = random.Random(7)
    tokens = [f"w{rng.randrange(10**6)}".encode() for _ in range(60_000)]
    start = time.perf_counter()
    assert not near_dup.similar(tokens, tokens[30_000:] + tokens[:30_000])
    assert near_dup.similar(tokens, tokens[2000:] + tokens[:2000])
    moved = tokens[:20_000] + tokens[21_000:50_000] + tokens[20_000:21_000] + tokens[50_000:]
    assert near_dup.similar(tokens, moved)
    assert time.perf_counter() - start < 3


def test_aligned_equals_the_full_table():
    rng = random.Random(8)
    for _ in range(300):
        a = np.array(rng.sample(range(60), rng.randint(1, 40)), dtype=np.uint64)
        b = np.array(rng.sample(range(60), rng.randint(1, 40)), dtype=np.uint64)
        row = [0] * (len(b) + 1)
        for x in a:
            above = row[:]
            for j, y in enumerate(b, 1):
                row[j] = above[j - 1] + 1 if x == y else max(above[j], row[j - 1])
        assert near_dup.aligned(a, b, 100) == row[-1]


def test_pages_of_one_template_stay_apart(frame, monkeypatch):
    """They share sketches, so that buckets are large, but only those with one text of their own
    are linked; sizes run over several classes."""
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", 100)
    rng = random.Random(10)
    template = [f"t{i}" for i in range(120)]
    own = [[f"p{page}x{i}" for i in range(rng.choice([40, 60, 90, 140, 200]))] for page in range(700)]
    texts = [" ".join([*template, *words]) for words in own]
    copies = [" ".join([*template, *edited(rng, own[page], 1)]) for page in range(0, 700, 50)]
    df = frame(list(enumerate(texts + copies)), "doc_id long, text string")
    found = {}
    for r in near_dup.near_duplicates(df).collect():
        found.setdefault(r.class_id, set()).add(r.doc_id)
    assert {tuple(sorted(c)) for c in found.values() if len(c) > 1} == {(page, 700 + page // 50) for page in range(0, 700, 50)}
