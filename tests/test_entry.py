"""The driver's entry point with and without the corpus operators and what they need."""

import subprocess
import sys

import __spark_entry__ as entry
from checks import oracle, registry

BLOCKED = """
import sys
sys.modules["{}"] = None
import __spark_entry__ as entry
print(*sorted(entry.queries()))
entry.oracle_sql()
"""


def test_missing_packages_leave_the_other_queries():
    for module in ("ahocorasick", "landmart.llm", "corpus_pipeline"):
        found = subprocess.run([sys.executable, "-c", BLOCKED.format(module)], capture_output=True, text=True, check=True, cwd=entry.__file__.rsplit("/", 1)[0])
        names = set(found.stdout.split())
        assert set(registry.queries()) <= names
        if module != "corpus_pipeline":
            assert names == set(registry.queries())


def test_every_sql_has_its_query():
    assert set(oracle.oracle_sql()) <= set(registry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
