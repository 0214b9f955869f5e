"""The registered queries without the optional text part."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROGRAM = """
import sys
sys.path.insert(0, {root!r})
sys.modules[{absent!r}] = None  # as if it were not installed
import __spark_entry__ as driver
from pluvia.parity import QUERIES, ORACLE
assert set(driver.queries()) == set(QUERIES) and set(driver.oracle_sql()) == set(ORACLE)
"""


@pytest.mark.parametrize("absent", ["pluvia.llm", "corpus_pipeline", "public_tokenizers", "xxhash"])
def test_other_queries_do_without_the_text_part(absent):
    done = subprocess.run([sys.executable, "-c", PROGRAM.format(root=ROOT, absent=absent)], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
