import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from shoalmark.llm import bpe
from shoalmark.llm.tokenizer_files import with_offsets

PATH = public_tokenizers.path("word_bpe_49k.json")


def agrees(text):
    own, library = bpe.word_bpe(PATH), with_offsets(PATH)
    ids = np.frombuffer(own.encode(text), dtype="<u4")
    expected = library.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == expected, text
    assert own.decode(ids.astype(np.int64)).decode() == library.decode(expected, skip_special_tokens=False)


def test_every_character():
    for start in range(0, 0x20000, 64):
        chars = [chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000]
        agrees(" ".join(chars))
        agrees("a".join(chars))


@pytest.mark.parametrize("seed", range(4))
def test_random_words(seed):
    rng = random.Random(seed)
    parts = ["a", "b", "th", "in", "er", "X", "é", "ß", "é", "Σ", "İ", "中", "😀", "'s", "'LL", "12", " ",
             "\n", "\x1c", "\x85", "　", "<|endoftext|>", "<|startoftext|>", "</w>", "!!", "...", "ﬁ", "x" * 40]
    for _ in range(1500):
        agrees("".join(rng.choice(parts) for _ in range(rng.randint(0, 14))))
    for _ in range(1500):
        agrees("".join(rng.choice("abeinorstuv") for _ in range(rng.randint(1, 25))))
    agrees("ab" * 20_000 + "a" * 3000)


def test_documents():
    for text in pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist():
        agrees(text or "")


def test_kept_words_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    monkeypatch.setattr(bpe, "KEPT_PAIRS", 3)
    own = bpe.WordBpe(PATH)
    expected = with_offsets(PATH).encode("one two three four five one two", add_special_tokens=False).ids
    assert np.frombuffer(own.encode("one two three four five one two"), "<u4").tolist() == expected
    assert len(own) <= 3 and len(own.pairs) <= 3


def test_frames(frame):
    texts = [None, "", "Same text", "Same text", "long " * 50_000, "<|endoftext|>x"]
    rows = [(None if i == 2 else i, t) for i, t in enumerate(texts)]
    df = frame(rows, "doc_id long, text string")
    library = with_offsets(PATH)
    expected = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, bpe.round_trip(df, PATH).collect()), key=repr) == sorted(expected, key=repr)
    decoded = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert sorted(hashlib.sha256(r.decoded.encode()).hexdigest() for r in decoded) == sorted(e[3] for e in expected)
    assert bpe.round_trip(frame([], "doc_id long, text string"), PATH).collect() == []
