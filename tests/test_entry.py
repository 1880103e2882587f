"""The entry point without the training-data packages."""

import os
import subprocess
import sys

from lexiflow.plans.catalog import QUERIES
from tests.conftest import ROOT

BLOCKED = """
import sys, warnings
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r} or name == {name!r}:
            raise ImportError(name + " is blocked", name=name)
sys.meta_path.insert(0, Block())
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), any("not registered" in str(w.message) for w in said))
"""


def test_core_queries_load_when_a_package_is_missing():
    for name in ("tiktoken", "lexiflow.llm", "corpus_pipeline"):
        out = subprocess.run([sys.executable, "-c", BLOCKED.format(name=name)], cwd=ROOT, capture_output=True,
                             text=True, timeout=120, check=True, env={**os.environ, "PYTHONPATH": ROOT}).stdout.split()
        assert int(out[0]) == len(QUERIES) and out[2] == "True", (name, out)
        assert int(out[1]) <= len(QUERIES)
