"""The library and its queries where the text operators are not installed."""

import subprocess
import sys
from pathlib import Path

HIDE = """
import importlib.abc, sys

class Hidden(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == "veil.llm" or name.startswith("veil.llm."):
            raise ModuleNotFoundError(name)

sys.meta_path.insert(0, Hidden())
import importlib.util
find = importlib.util.find_spec
importlib.util.find_spec = lambda name, package=None: None if name.startswith("veil.llm") else find(name, package)
import __spark_entry__ as registered
names = set(registered.queries())
assert set(registered.oracle_sql()) <= names
assert "publish" in names and "pipeline" not in names and not any(n.startswith("op") and n[2].isdigit() for n in names)
import bench
"""


def test_queries_without_text_operators():
    subprocess.run([sys.executable, "-c", HIDE], cwd=Path(__file__).parent.parent, check=True, timeout=120)
