"""The entry module loads without Spark's jar folder and without the optional parts."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

HIDDEN = """
import builtins, glob, sys, zipfile
def no(*a, **k): raise OSError("no jars here")
zipfile.ZipFile = no
glob.glob = lambda *a, **k: []
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
assert len(q) >= 69 and set(o) <= set(q) and all(isinstance(s, str) for s in o.values())
print(len(q), len(o))
"""

WITHOUT = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("textquarry.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert not [n for n in e.queries() if n.startswith("op") or n == "pipeline"]
assert len(e.queries()) >= 69
"""


@pytest.mark.parametrize("code", [HIDDEN, WITHOUT])
def test_registry_loads(code):
    r = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert r.returncode == 0, r.stderr[-2000:]
