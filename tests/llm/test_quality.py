import random
import re

from pyspark.sql import functions as F
from shoalmark.llm import quality


def brute(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    seen, repeated = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            repeated |= {p + j for p in places for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    chars = sum(map(len, words))
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    count = lambda line, of: sum(c in of for c in line)
    clean = [x for x in lines
             if re.search(quality.SENTENCE_END.replace("\\z", "\\Z"), x)
             and count(x, quality.SYMBOLS) <= 0.05 * len(x) and count(x, "!?") <= 0.05 * len(x)
             and count(x, quality.SEPARATORS) <= 2
             and not (len(x) <= 200 and re.search(quality.STOCK_PHRASES, x))]
    left = len(re.sub(r"[\x20\x09-\x0D]", "", "".join(clean)))
    return (len(words), chars, count(text, quality.SYMBOLS), len(lines) - len(set(lines)),
            len(repeated), failed, not failed and left >= 0.7 * chars, "\n".join(clean))


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text")


def test_equals_brute_force(frame):
    rng = random.Random(2)
    parts = ["a", "b", "word", "Ünï", "😀", "x***", "|", "\t", "\n", "\n\n", "\x0b", "\x85", " ", "end.",
             "Stop!", "what?!", "licensed under", "", "c d e f g", "\r\n", '."', "$5", "•"]
    texts = [None, "", " \n\t", "a b", "one. " * 60, "same line.\n" * 30, "x y z " * 20_000]
    texts += [" ".join(rng.choice(parts) for _ in range(rng.choice([3, 30, 120]))) for _ in range(250)]
    texts += [" ".join(f"w{rng.randint(0, 300)}" + rng.choice(["", ".", "\n"]) for _ in range(90)) for _ in range(60)]
    rows = [(None if i == 3 else i // 2, t) for i, t in enumerate(texts)]
    df = frame(rows, "doc_id long, text string").withColumn("kept", F.lit("clash")).withColumn("__n", F.lit(1))
    found = sorted((tuple(r[c] for c in COLUMNS) for r in quality.assess(df).collect()), key=repr)
    assert found == sorted(map(brute, texts), key=repr)


def test_filter_on_the_verdict_keeps_the_arrays_apart(frame):
    plan = quality.assess(frame([(1, "a")], "doc_id long, text string")).where("kept")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("split(translate") == 1
    assert "Python" not in text


def test_empty(frame):
    assert quality.assess(frame([], "doc_id long, text string")).collect() == []


def test_copies_apart_within_one_hash(frame):
    """Another window with the same kept hash bits lies between two copies."""
    words = [f"f{i}" for i in range(110)]
    words[0:3] = words[100:103] = ["a", "b", "c"]
    ordered = [(5 << quality.PLACE_BITS) | place for place in (0, 50, 100)]
    df = frame([(words, ordered)], "words array<string>, ordered array<long>")
    assert df.select(quality.repeated_places(F.col("words"), F.col("ordered"))).first()[0] == [0, 100]


def test_columns_with_other_case_and_the_names_of_helpers(frame):
    text = "\n".join(f"w{i}a w{i}b w{i}c w{i}d." for i in range(40))
    df = frame([(1, text)], "doc_id long, text string").withColumns(
        {name: F.lit("mine") for name in ("KEPT", "Clean_Text", "__words", "__LINES", "__windows", "__places", "__clean")})
    row = quality.assess(df).where("kept").first()
    assert row.kept is True and row.clean_text == text and row["__words"] == row["__LINES"] == "mine"
