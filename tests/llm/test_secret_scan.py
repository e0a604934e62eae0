import random
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from shoalmark.llm import secret_scan as scan


def brute(text):
    found = []
    for number, rule in enumerate(scan.RULES):
        for m in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), number, rule.kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


SECRETS = [
    'token = "0123456789abcdef0123"', "PassWord:'Sup3rSecretValue'", "api_key=short", "apikey : AAAABBBBCCCC",
    "secret: token: abcdefghijklmnop", "paſſword = abcdefghijklmnop", "toKen = abcdefghijklmnop", "AKIA" + "Z9" * 8, "AKIASHORT", "AKIAAKIA" + "B" * 12,
    "deadbeef" * 3, "deadbeef", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 18, "xoxb-1234567890-abc",
    "AIza" + "x" * 35, "sk_live_" + "7" * 20, "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl", "postgresql://user:pa55@host/db"]


def test_equals_a_full_scan(frame):
    rng = random.Random(11)
    parts = SECRETS + ["word ", "Ünï ", "😀", "\n", " ", "<", "tok", "en", "x" * 30, "aki", "KIA", "://", "a:b@"]
    texts = [None, "", "\0", "clean prose " * 20_000, "a" * 3_000_000 + ' token="abcdefghijklmnop"', "é😀" * 400_000 + SECRETS[0]]
    texts += ["".join(rng.choice(parts) for _ in range(rng.choice([1, 3, 12]))) for _ in range(500)]
    rows = [(None if i % 37 == 0 else i // 2, t) for i, t in enumerate(texts)]
    df = frame(rows, "doc_id long, text string").withColumn("spans", F.lit("clash")).withColumn("kind", F.lit(1))
    found = sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in scan.scan(df).collect()), key=repr)
    assert found == sorted(((doc_id, brute(t)) for doc_id, t in rows), key=repr)
    assert {s[0] for _, spans in found for s in spans} == {rule.kind for rule in scan.RULES}


def test_empty(frame):
    assert scan.scan(frame([], "doc_id long, text string")).collect() == []


def test_prose_has_no_spans(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = scan.scan(documents).where(F.size("spans") > 0)
    # All that is found there are the planted tokens, each with the digits of its value.
    assert {tuple(sorted({s.kind for s in r.spans})) for r in found.collect()} <= {("hex",), ("assign", "hex"), ("access",)}


def satisfied(query, text):
    if query == scan.ALL:
        return True
    if query[0] == "gram":
        return query[1] in text.encode().lower()
    return (all if query[0] == "and" else any)(satisfied(q, text) for q in query[1])


@pytest.mark.parametrize("pattern, needs", [
    ("abcd", ("and", frozenset({("gram", b"abc"), ("gram", b"bcd")}))),
    ("a[bB]c", ("gram", b"abc")),
    ("abc|xyz", ("or", frozenset({("gram", b"abc"), ("gram", b"xyz")}))),
    ("(?:abc)?", scan.ALL), ("a.c", scan.ALL), ("[0-9a-f]+", scan.ALL), ("abc*", scan.ALL), ("ab|abc", scan.ALL),
    ("abc+", ("gram", b"abc")), (r"\bkey\b", ("gram", b"key")), ("(?=zzz)key", ("gram", b"key")),
    ("abc|abcd", ("gram", b"abc")), ("é+key", ("gram", b"key")),
])
def test_queries(pattern, needs):
    assert scan.trigram_query(pattern) == needs


PIECES = st.sampled_from(["a", "b", "ab", "[ab]", "[a-z]", ".", "abc", "(?i:cA)", r"\w", "c"])


@st.composite
def patterns(draw, depth=3):
    if depth == 0:
        return draw(PIECES)
    inner = patterns(depth=depth - 1)
    return draw(st.one_of(
        PIECES, st.tuples(inner, inner).map("".join), st.tuples(inner, inner).map(lambda p: f"(?:{p[0]}|{p[1]})"),
        st.tuples(inner, st.sampled_from(["?", "*", "+", "{2}", "{1,3}", "{4}"])).map(lambda p: f"(?:{p[0]}){p[1]}")))


@settings(max_examples=400, deadline=None)
@given(patterns(), st.text("abcABCx", max_size=12))
def test_a_query_never_rules_out_a_match(pattern, text):
    if re.search(pattern, text, re.ASCII):
        assert satisfied(scan.trigram_query(pattern), text)


def test_postings_and_candidates_spare_documents():
    texts = pa.array(["no such word", "a TOKEN here", None, "", "tok en", "kento oke ken tok", "token"] * 3)[1:-1].fill_null("")
    scanner = scan.Scanner([scan.Rule("t", "token"), scan.Rule("any", "[0-9]+")])
    index = scanner.index(texts)
    grams = {g: [i for i, t in enumerate(texts.to_pylist()) if g in t.encode().lower()] for g in (b"tok", b"oke", b"ken")}
    assert {g: index.postings(g).tolist() for g in grams} == grams
    assert index.candidates(scanner.queries[0]).tolist() == sorted(set.intersection(*map(set, grams.values())))
    assert index.candidates(scanner.queries[1]).tolist() == list(range(len(texts)))


def test_trigrams_over_the_edge_of_a_window(monkeypatch):
    monkeypatch.setattr(scan, "WINDOW", 7)
    texts = pa.array([("x" * i) + "token" + "y" * (i % 3) for i in range(25)] + ["tok", "en", ""])
    scanner = scan.Scanner([scan.Rule("t", "token")])
    assert scanner.index(texts).candidates(scanner.queries[0]).tolist() == list(range(25))
