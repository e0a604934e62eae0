"""The entry file where the training-data subpackage, or a library of it, is missing."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["corpus_pipeline", "shoalmark.llm", "tiktoken", "public_tokenizers"])
def test_the_rest_is_registered_without(missing):
    code = (f"import sys; sys.modules[{missing!r}] = None\n"
            "import __spark_entry__ as e\n"
            "from shoalmark.plans.queries import QUERIES\n"
            "print(set(e.queries()) == set(QUERIES), set(e.oracle_sql()) <= set(QUERIES))")
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["True", "True"], done.stderr[-2000:]
