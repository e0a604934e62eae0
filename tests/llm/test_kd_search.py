import math
import random

import numpy as np
import pytest
from shoalmark.llm import kd_search


def brute(rows, k, every):
    good = []
    for vec_id, v in rows:
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((vec_id, [math.floor(1024 * x) for x in v]))
    scored = {}
    for q, a in good:
        if q % every == 0:
            scored.setdefault(q, []).extend((-sum(x * y for x, y in zip(a, b)), p) for p, b in good
                                            if p != q and len(b) == len(a))
    return sorted((q, n, p, -s) for q, of_q in scored.items() for n, (s, p) in enumerate(sorted(of_q)[:k], 1))


@pytest.mark.parametrize("seed,shard_rows,query_rows", [(1, 50, 7), (2, 40, 1000), (3, 10_000, 3)])
def test_equals_brute_force(frame, seed, shard_rows, query_rows):
    rng = random.Random(seed)
    hot = [rng.gauss(0, 1) for _ in range(6)]
    rows = []
    for i in range(300):
        v = hot if rng.random() < 0.3 else [rng.choice([-1.0, 0.0, 0.5, rng.gauss(0, 1)]) for _ in range(6)]
        rows.append((i, v))
    rows += [rows[7]] * 3 + [rows[20]] * 2 + [(8, rows[7][1])] * 14
    rows += [(300, None), (301, [None] * 6), (302, [float("nan")] * 6), (None, hot), (5, rows[5][1]),
             (303, [float("inf")] * 6), (310, []), (320, []), (330, [1.0]), (340, [1.0, 2.0])]
    df = frame(rows, "vec_id long, embedding array<float>")
    exact = [(i, None if v is None else [None if x is None else x for x in v])
             for i, v in [(r.vec_id, r.embedding) for r in df.collect()]]
    found = kd_search.top_k(kd_search.integer_vectors(df), k=10, query_every=10,
                            shard_rows=shard_rows, query_rows=query_rows, leaf_size=4)
    assert sorted(map(tuple, found.collect())) == brute(exact, 10, 10)


def test_large_integers_stay_exact(frame):
    rows = [(i, [60000.0 + i / 7, -59999.0 + i * 1.7, 3.0 * i]) for i in range(40)]
    df = frame(rows, "vec_id long, embedding array<double>")
    found = kd_search.top_k(kd_search.integer_vectors(df), k=3, query_every=10, shard_rows=16)
    assert sorted(map(tuple, found.collect())) == brute(rows, 3, 10)


def test_few_and_none(frame):
    schema = "vec_id long, embedding array<float>"
    assert kd_search.top_k(kd_search.integer_vectors(frame([], schema))).collect() == []
    one = kd_search.integer_vectors(frame([(100, [1.0]), (1, [2.0])], schema))
    assert list(map(tuple, kd_search.top_k(one).collect())) == [(100, 1, 1, 1024 * 2048)]


def test_every_finite_vector_takes_part(frame):
    rows = [(0, [65536.0, 1.0]), (1, [-70000.5, 2.0]), (2, [1e6, 0.25]), (10, [1.0, 1.0]), (11, [0.5, -3.0])]
    df = frame(rows, "vec_id long, embedding array<double>")
    found = kd_search.top_k(kd_search.integer_vectors(df), k=3, query_every=10, shard_rows=2)
    assert sorted(map(tuple, found.collect())) == brute(rows, 3, 10)


def test_large_scores_above_the_precision_of_doubles(frame):
    rng = random.Random(9)
    rows = [(i, [2.0**20 + rng.randrange(3) / 1024, 2.0**20]) for i in range(60)]
    df = frame(rows, "vec_id long, embedding array<double>")
    found = kd_search.top_k(kd_search.integer_vectors(df), k=4, query_every=10, shard_rows=7, leaf_size=2)
    assert sorted(map(tuple, found.collect())) == brute(rows, 4, 10)


@pytest.mark.parametrize("value", [1e9, 1e300])
def test_what_does_not_fit_is_an_error(frame, value):
    df = frame([(0, [value] * 8), (1, [value] * 8)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="do not fit 64 bits|component too large"):
        kd_search.top_k(kd_search.integer_vectors(df)).collect()


def test_queries_go_only_to_shards_whose_boxes_reach(frame, monkeypatch):
    """Of clustered vectors, counted (query, shard) pairs against all of them."""
    counted = []
    reached = kd_search.reached_shards

    def watched(*args):
        out = reached(*args)
        counted.append(out.count())
        return out

    monkeypatch.setattr(kd_search, "reached_shards", watched)
    rng = random.Random(21)
    centres = [[rng.choice([-1.0, 1.0]) * 4 for _ in range(12)] for _ in range(16)]
    rows = [(i, [x + rng.gauss(0, 0.3) for x in rng.choice(centres)]) for i in range(3200)]
    df = frame(rows, "vec_id long, embedding array<double>")
    found = kd_search.top_k(kd_search.integer_vectors(df), k=5, query_every=40, shard_rows=100, query_rows=16)
    assert sorted(map(tuple, found.collect())) == brute(rows, 5, 40)
    assert counted[0] < 0.3 * 80 * 32


def test_every_row_falls_into_its_leaf():
    rng = np.random.default_rng(5)
    sample = rng.integers(-50, 50, (2000, 4))
    splits = kd_search.shard_splits(sample, 32)
    leaves = kd_search.leaf_numbers(sample, splits)
    sizes = np.bincount(leaves)
    assert len(sizes) == 32 and sizes.min() >= 20 and sizes.max() <= 150
    assert kd_search.shard_splits(np.ones((500, 3), dtype=np.int64), 8) == []
