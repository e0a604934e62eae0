import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from shoalmark.llm import fill_in_middle as fim

GEAR = fim._gear()
TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = TOKEN.findall(text)
    n = len(units)
    if text == "" or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(part) for part in (units[:low], units[low:high], units[high:]))
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_equals_brute_force_and_restores(frame):
    rng = random.Random(13)
    parts = ["a", "Word", "Ünï", "😀", " ", "\n", "<P", "<", ">", "S>", "M>", "P>", "1", "é" * 40, "x" * 90, "\x85", "\0b"]
    texts = [None, "", " ", "a", "<P>", "see <M> there", "x" * 70_000, "é" * 30_000, "ab cd " * 20_000, "😀" * 3000]
    texts += ["".join(rng.choice(parts) for _ in range(rng.choice([1, 5, 60, 400, 3000]))) for _ in range(300)]
    texts += texts[-20:]
    rows = [(None if i % 41 == 0 else i, t) for i, t in enumerate(texts)] + [(7, "again"), (7, "again")]
    df = frame(rows, "doc_id long, text string").withColumn("form", F.lit("clash")).withColumn("TEXT_", F.lit(1))
    made = fim.transform(df).withColumn("restored", fim.restore(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(r)[:6] for r in made), key=repr) == sorted((brute(*row) for row in rows), key=repr)
    assert sorted(r.restored for r in made) == sorted(t or "" for _, t in rows)
    assert {r.form for r in made} == set(fim.FORMS)


def test_empty(frame):
    assert fim.transform(frame([], "doc_id long, text string")).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "bc", "é", "😀", " ", "Z" * 60, "- ", "word word. " * 9]), max_size=80))
def test_every_token_starts_where_a_scan_finds_it(parts):
    text = "".join(parts)
    counted = fim.CountedText(text.encode(), fim.ChunkCache(), GEAR)
    starts = [len(text[:m.start()].encode()) for m in TOKEN.finditer(text)]
    assert len(counted) == len(starts)
    assert [counted.start(i) for i in range(len(starts) + 1)] == [*starts, len(text.encode())]


def test_rolling_hash_is_the_sum_over_its_window():
    data = np.frombuffer(random.Random(1).randbytes(300), dtype=np.uint8)
    plain = [sum(int(GEAR[data[i - age]]) << age for age in range(32) if i >= age) % 2**32 for i in range(len(data))]
    assert fim.rolling_hashes(data, GEAR).tolist() == plain


def test_a_passage_gives_the_same_chunks_wherever_it_lies():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = " ".join(word() for _ in range(400)).encode()
    cache = fim.ChunkCache()
    fim.CountedText(b"one text: " + passage, cache, GEAR)
    misses = cache.misses
    fim.CountedText(b"another and longer beginning, then: " + passage + b" and an end", cache, GEAR)
    assert cache.hits >= 0.7 * misses
    assert cache.misses - misses <= 0.3 * misses


def test_chunks_have_limits_and_whole_characters():
    text = ("é" * 5000 + "a" * 5000 + "plain words here " * 500).encode()
    ends = fim.chunk_ends(text, GEAR)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(text) and sizes.max() <= fim.MOST_CHUNK and sizes.min() > 0
    assert all(text[end] & 0xC0 != 0x80 for end in ends[:-1])


def test_cache_is_bounded_and_verifies_content():
    cache = fim.ChunkCache(limit=4000)
    for i in range(1000):
        assert cache.summary(b"%08d" % i + b" ab" * 10) == fim.summarise(b"%08d" % i + b" ab" * 10)
    assert sum(map(len, [*cache.young, *cache.old])) <= 4000 + 2 * 38
