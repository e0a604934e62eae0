import re

import __spark_entry__ as contract
import corpus_pipeline
import pyarrow.parquet as pq
import pytest
from shoalmark.llm import language, near_dup
from shoalmark.llm.common import words

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """Each stage's input and output rows."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), []
    for k, (name, function) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/{k}"
        function(spark, docs, DATA).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs.columns, [tuple(r) for r in docs.collect()], after.columns, [r.asDict() for r in after.collect()]))
        docs = after
    return {name: rest for name, *rest in out}


def test_stages_in_order_and_registered(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "quality_rules", "line_dedup", "near_dedup", "best_fit_packing"]
    assert "pipeline" in contract.queries() and "pipeline" not in contract.oracle_sql()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in contract.queries() if re.match(r"op\d+_", q)}


def test_columns_stay(results):
    columns = pq.read_schema(f"{DATA}/documents.parquet").names
    for name, (_, _, after, _) in results.items():
        assert name == "best_fit_packing" or after == columns


def test_language(results):
    _, before, _, after = results["language_id"]
    assert 0.9 * len(before) < len(after) <= len(before)
    assert all(any(map(str.isalpha, r["text"])) for r in after)


def test_quality_equals_brute_force(results):
    from llm.test_quality import brute

    columns, before, _, after = results["quality_rules"]
    want = {}
    for row in before:
        r = dict(zip(columns, row))
        *_, kept, clean = brute(r["text"])
        if kept:
            want[r["doc_id"]] = (clean, len(clean))
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in after} == want


def test_lines(results):
    columns, before, _, after = results["line_dedup"]
    texts = {row[columns.index("doc_id")]: row[columns.index("text")] for row in before}
    first = {}
    for r in after:
        kept, whole = r["text"].split("\n"), iter(texts[r["doc_id"]].split("\n"))
        assert all(any(line == x for x in whole) for line in kept)
    for doc_id in sorted(texts):
        for line in texts[doc_id].split("\n"):
            if len(re.findall(r"[^\x20\x09-\x0D]+", line)) >= 10:
                first.setdefault(line, doc_id)
    long_lines = [line for r in after for line in r["text"].split("\n") if line in first]
    assert sorted(long_lines) == sorted(first)


def test_near_duplicates(results):
    columns, before, _, after = results["near_dedup"]
    rows = [(r[columns.index("doc_id")], words(r[columns.index("text")])) for r in before]
    root = {d: d for d, _ in rows}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if x and y and min(len(x), len(y)) >= 0.75 * max(len(x), len(y)) and near_dup.similar(x, y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert sorted(r["doc_id"] for r in after) == sorted(d for d, _ in rows if find(d) == d)


def test_packing_covers_all_that_is_kept(results):
    _, before, _, after = results["best_fit_packing"]
    assert {r["doc_id"] for r in after} == {row[0] for row in before}


def test_clashing_columns_and_empty_tables(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(40)
    for name in ("lang_pred", "lang_share", "n_words", "kept", "n_lines", "n_removed", "key"):
        docs = docs.withColumn(name, F.lit("x"))
    for none in (False, True):
        rows = docs.limit(0) if none else docs
        for name, function in corpus_pipeline.STAGES:
            out = function(spark, rows, DATA)
            if name != "best_fit_packing":
                assert out.count() <= 40 and (out.columns == docs.columns or name == "language_id")
    assert language.UNDETERMINED == "und"


def test_unlabelled_documents_stay(frame):
    rows = [(i, t, None) for i, t in enumerate(["Some words.", "é", "12 %", "", None])]
    docs = frame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.identify_language(docs.sparkSession, docs, DATA)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1] and kept.columns == docs.columns
