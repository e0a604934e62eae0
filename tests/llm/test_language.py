import itertools
import math
import random
import zlib

import numpy as np
import pytest
from shoalmark.llm import language

PIECES = {"aa": ["ka", "lo", "mi", "tu", "ra"], "bb": ["sch", "ung", "ein", "ver", "ö"], "cc": ["ci", "ón", "ñ", "que", "lo"]}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(PIECES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_posteriors_equal_enumeration():
    rng = np.random.default_rng(3)
    emission, step = rng.random((6, 3)) + 0.05, rng.random((3, 3)) + 0.05
    chains = [np.array([1, 4, 2, 5]), np.array([3]), np.array([0, 0])]
    table = language.Chains.of(chains, [0, 1, 2])
    found, expected = language.posteriors(table, emission, step)
    moves = np.zeros((3, 3))
    for column, owner in enumerate(table.owner):
        words = chains[owner]
        total, share, within = 0.0, np.zeros((len(words), 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=len(words)):
            p = np.prod([emission[w, s] for w, s in zip(words, path)]) * np.prod(
                [step[a, b] for a, b in itertools.pairwise(path)])
            total += p
            for t, s in enumerate(path):
                share[t, s] += p
            for a, b in itertools.pairwise(path):
                within[a, b] += p
        moves += within / total
        assert np.allclose(found[:len(words), column], share / total)
        assert not found[len(words):, column].any()
    assert np.allclose(expected, moves)


def test_features_hold_affixes_and_the_word():
    ids, starts = language.word_features(["abc", "abd", "abc", "x"])
    sets = [set(ids[a:b]) for a, b in zip(starts, [*starts[1:], len(ids)])]
    assert sets[0] == sets[2] != sets[1]
    assert len(sets[0] & sets[1]) == 3 + 0  # the marks with a, with ab, and ab itself


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(300):
        lang = rng.choice(sorted(PIECES))
        text = "\n".join(sentence(rng, lang, rng.randint(3, 30)) + "." for _ in range(rng.randint(1, 5)))
        out.append((i, text.upper() if i % 9 == 0 else text, lang if i % 11 else None))
    mixed = "\n".join([sentence(rng, "aa", 30), sentence(rng, "bb", 10)])
    out += [(900, None, "aa"), (901, "", "aa"), (902, "12 34 ² _ !", "bb"), (None, sentence(rng, "cc", 20), "cc"),
            (903, mixed, "aa"), (904, sentence(rng, "bb", 5000), "bb"), (out[0]), (905, "é 中文", None)]
    return out


def test_accuracy_and_special_cases(frame, rows):
    df = frame(rows, "doc_id long, text string, lang string")
    found = language.predict(df, language.train(df)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for doc_id in (900, 901, 902):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score) == ("und", 0.0)
    right = [by_id[i].lang_pred == lang for i, text, lang in rows if lang and i is not None and i < 900 and by_id[i].held_out]
    assert len(right) > 40 and np.mean(right) > 0.97
    assert by_id[903].lang_pred == "aa" and 0.6 < by_id[903].score < 0.9
    assert by_id[904].lang_pred == "bb" and by_id[904].score > 0.95
    assert by_id[905].lang_pred != "und"
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)


def test_words_of_switched_text_are_told_apart(frame, rows):
    df = frame(rows, "doc_id long, text string, lang string")
    labels = language.train(df)
    rng = random.Random(8)
    text = sentence(rng, "bb", 12) + " " + sentence(rng, "cc", 12)
    numbers = labels.numbers([language.WORD.findall(text)])
    share, _ = language.posteriors(language.Chains.of([np.array(numbers[0])], [0]), labels.emission, labels.step)
    best = share[:, 0].argmax(axis=1)
    truth = [labels.languages.index("bb")] * 12 + [labels.languages.index("cc")] * 12
    assert (best == truth).mean() > 0.9


def test_prediction_uses_the_text_alone_and_bounds_hold(frame, rows, monkeypatch):
    df = frame(rows, "doc_id long, text string, lang string")
    labels = language.train(df)
    plain = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in language.predict(df, labels).collect()}
    monkeypatch.setattr(language, "KEPT_WORDS", 50)
    monkeypatch.setattr(language, "BATCH_WORDS", 40)
    texts = [t or "" for _, t, _ in rows]
    shares = labels.shares(texts, len(texts))
    for (doc_id, _, _), share in zip(rows, shares):
        if plain[doc_id][0] != "und":
            assert plain[doc_id] == (labels.languages[share.argmax()], pytest.approx(share.max() / share.sum(), abs=1e-6))


def test_nothing_to_learn(frame):
    schema = "doc_id long, text string, lang string"
    assert language.predict(frame([], schema), language.train(frame([], schema))).collect() == []
    df = frame([(1, "word", None)], schema)
    assert [(r.lang_pred, r.score) for r in language.predict(df, language.train(df)).collect()] == [("und", 0.0)]


def plainly(labels, text):
    """Label and score of a text, by forward-backward over each whole line in plain Python."""
    n, expected = len(labels.languages), [0.0] * len(labels.languages)
    step = labels.step.tolist()
    for line in text.lower().split("\n"):
        words = [w for w in language.WORD.findall(line) if any(map(str.isalpha, w))]
        evidence = []
        for word in words:
            scores = labels.weights[language.word_features([word])[0]].sum(axis=0, dtype=np.float64)
            evidence.append([max(math.exp(s - max(scores)), 1e-30) for s in scores])
        forward = []
        for t, e in enumerate(evidence):
            now = [e[b] * (sum(forward[-1][a] * step[a][b] for a in range(n)) if t else 1.0) for b in range(n)]
            forward.append([x / sum(now) for x in now])
        after = [1.0] * n
        for t in range(len(words) - 1, -1, -1):
            both = [f * b for f, b in zip(forward[t], after)]
            for a in range(n):
                expected[a] += both[a] / sum(both)
            back = [sum(step[a][b] * evidence[t][b] * after[b] for b in range(n)) for a in range(n)]
            after = [x / sum(back) for x in back]
    if not sum(expected):
        return "und", 0.0
    return labels.languages[expected.index(max(expected))], max(expected) / sum(expected)


def test_labels_and_scores_equal_plain_forward_backward(frame, rows):
    rng = random.Random(12)
    long_line = " ".join(sentence(rng, rng.choice(sorted(PIECES)), 40) for _ in range(30))
    cases = [*rows[:40], *rows[-9:], (2000, long_line, None), (2001, long_line + "\n" + sentence(rng, "cc", 700), None)]
    df = frame(rows, "doc_id long, text string, lang string")
    labels = language.train(df)
    found = language.predict(frame(cases, "doc_id long, text string, lang string"), labels).collect()
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in found}
    for doc_id, text, _ in cases:
        label, score = plainly(labels, text or "")
        assert by_id[doc_id] == (label, pytest.approx(score, abs=1e-5))


def test_too_many_languages_raise(frame, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 5)
    df = frame([(i, "word", f"l{i}") for i in range(7)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 5"):
        language.train(df)
