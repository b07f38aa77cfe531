"""The entry points work with the llm package and without it."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(block: str) -> set[str]:
    code = f"""
import importlib.abc, sys
class Gone(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name in {block!r}.split():
            raise ModuleNotFoundError("No module named " + name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
print("NAMES", *e.queries())
assert set(e.oracle_sql()) <= set(e.queries())
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    return set(out.stdout.partition("NAMES")[2].split())


def test_without_the_llm_package_the_other_queries_stay():
    from tallyspan.plans import QUERIES

    assert names("tallyspan.llm corpus_pipeline") == set(QUERIES)
    assert set(QUERIES) <= names("")


def test_nothing_else_imports_the_llm_package():
    for folder, _, files in os.walk(os.path.join(ROOT, "tallyspan")):
        if os.path.basename(folder) != "llm":
            for name in files:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name)) as file:
                        assert "tallyspan.llm" not in file.read()
