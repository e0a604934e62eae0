import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from shoalmark.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "copies")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    fields = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in fields])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(tree, place):
    for level in tree[:-1]:
        run = level[place - place % 8:place - place % 8 + 8]
        yield "".join(run[:place % 8]), "".join(run[place % 8 + 1:])
        place //= 8


def brute(rows):
    lower = str.maketrans(merkle.UPPER, merkle.LOWER)
    trees = {}
    for row in rows:
        doc_id, text = row[:2]
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        changed = leaf(doc_id, text and text.translate(lower), *row[2:]) if hit else None
        trees.setdefault(row[2], []).append((doc_id is not None, doc_id or 0, leaf(*row), doc_id, changed))
    names = sorted(trees, key=lambda name: (name is not None, (name or "").encode()))
    built = {name: levels([d[2] for d in sorted(trees[name], key=lambda d: d[:3])]) for name in names}
    top = levels([built[name][-1][0] for name in names])
    out = []
    for number, name in enumerate(names):
        for place, (_, _, digest, doc_id, changed) in enumerate(sorted(trees[name], key=lambda d: d[:3])):
            path = [*siblings(built[name], place), *siblings(top, number)]
            node, copies = changed or digest, []
            for left, right in path:
                node = h(left, node, right)
                copies.append(node)
            out.append((doc_id, digest, built[name][-1][0], top[-1][0], h(*[a + b for a, b in path]), node,
                        node == top[-1][0], copies if changed else []))
    return out


def check(frame, rows, levels=merkle.BLOCK_LEVELS):
    df = frame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("tree", "LEAF", "root", "block", "slot", "digest")})
    found = [tuple(r[c] for c in COLUMNS) for r in merkle.manifest(df, levels).collect()]
    assert sorted(found, key=repr) == sorted(brute(rows), key=repr)
    return found


def test_equals_brute_force(frame):
    rng = random.Random(12)
    rows = [(None if rng.random() < 0.02 else rng.randrange(900), rng.choice([None, "", "Some Text", "ünï A", "x" * 200_000, f"T{i}"]),
             rng.choice([None, "", "en", "en", "en", "en", "de", "Zz", "é", "1"]), rng.choice([None, "s"]), rng.choice([None, 3]))
            for i in range(1500)]
    found = check(frame, rows + rows[:40])
    assert {r[6] for r in found} == {True, False}


@pytest.mark.parametrize("sizes", [[1], [1, 1], [8], [9, 1], [513], [64, 65, 1, 7], [512, 511]])
def test_shapes(frame, sizes):
    check(frame, [(i, f"Text {i}", f"l{lang}", "s", 1) for lang, n in enumerate(sizes) for i in range(n)])


@pytest.mark.parametrize("levels", [1, 2])
def test_several_rounds(frame, levels):
    check(frame, [(i, f"Text {i}", "en" if i % 7 else "de", "s", i) for i in range(700)], levels)


def test_many_languages(frame):
    check(frame, [(i, "A", f"lang{i % 601}", "s", None) for i in range(700)])


def test_a_leaf_repeated_more_often_than_a_row_stands_for(frame, monkeypatch):
    monkeypatch.setattr(merkle, "COPIES", 16)
    check(frame, [(5, "Same", "en", "s", 4)] * 300 + [(None, None, None, None, None)] * 40 + [(i, "B", "en", "s", 1) for i in range(30)])


def test_beyond_the_broadcast_budget(frame, no_broadcast):
    check(frame, [(i, f"T{i}", "en" if i % 3 else None, "s", 1) for i in range(600)])


def test_empty(frame):
    assert merkle.manifest(frame([], SCHEMA)).collect() == []


def test_a_version_shares_the_tree():
    tree = merkle.BlockTree([h(str(i)) for i in range(100)], 100, 3)
    before = [list(level) for level in tree.levels]
    copies = merkle.version(h("other"), tree.path(42))
    assert tree.levels == before
    assert len(copies) == len(tree.levels) - 1
    changed = merkle.BlockTree([h("other") if i == 42 else h(str(i)) for i in range(100)], 100, 3)
    assert copies == [changed.levels[k + 1][42 // 8 ** (k + 1)] for k in range(len(copies))]
    same = sum(a == b for x, y in zip(tree.levels, changed.levels) for a, b in zip(x, y))
    assert same == sum(map(len, tree.levels)) - len(copies) - 1
