"""The entry file stands when the training-data operators can't be imported."""

import subprocess
import sys

HIDDEN = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as entry
from careledger.queries import ORACLES, QUERIES
assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLES)
"""


def test_a_missing_dependency_leaves_the_rest():
    for name in ("tiktoken", "public_tokenizers", "corpus_pipeline", "careledger.llm"):
        subprocess.run([sys.executable, "-c", HIDDEN.format(name=name)], check=True, timeout=120)
