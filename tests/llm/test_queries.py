"""The registered queries: what they return, over whole tables."""

import subprocess
import sys

import pytest
from shoalmark.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
CONTRACT = {
    "op1": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op2": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op3": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op4": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op5": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op6": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op7": "doc_id bigint, class_id bigint, class_size bigint",
    "op8": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op9": "doc_id bigint, n_lines int, n_removed int, text_md5 string",
    "op10": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
            "base_failed boolean, kept boolean",
    "op11": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op12": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    "op13": "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string",
}
BY_OP = {name.split("_")[0]: name for name in QUERIES}
ONE_ROW_EACH = {"op1": ("pages", "page_id"), **{op: ("documents", "doc_id") for op in ("op5", "op6", "op7", "op8", "op9", "op10", "op11", "op12", "op13")}}


@pytest.mark.parametrize("op", sorted(CONTRACT))
def test_columns_and_rows(spark, op):
    result = QUERIES[BY_OP[op]](spark, DATA)
    assert {f"{c} {t}" for c, t in result.dtypes} == set(CONTRACT[op].split(", "))
    if op in ONE_ROW_EACH:
        name, key = ONE_ROW_EACH[op]
        table = spark.read.parquet(f"{DATA}/{name}.parquet")
        assert sorted(r[0] for r in result.select(key).collect()) == sorted(r[0] for r in table.select(key).collect())


def test_workers_get_the_package_from_spark(tmp_path):
    """From another folder and without PYTHONPATH the workers still import what tasks call."""
    code = f"""
import sys
sys.path.insert(0, {str(__file__).rsplit("/tests/", 1)[0]!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from shoalmark.llm.queries import QUERIES
print("rows", QUERIES["op4_chat_formatting"](spark, {DATA!r}).count())
"""
    env = {k: v for k, v in __import__("os").environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "rows" in done.stdout, done.stderr[-2000:]
