"""The entry keeps the library's queries whatever the training-data folder lacks."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
CODE = """
import sys, warnings
sys.modules[{name!r}] = None  # importing it raises ImportError
with warnings.catch_warnings(record=True) as seen:
    warnings.simplefilter("always")
    import __spark_entry__ as E
assert any("left out" in str(w.message) for w in seen)
assert E.llm is None and len(E.queries()) > 90 and set(E.oracle_sql()) <= set(E.queries())
"""


def test_a_missing_package_or_folder_leaves_the_library(tmp_path):
    for name in ("xxhash", "strata.llm"):
        r = subprocess.run([sys.executable, "-c", CODE.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=300)
        assert r.returncode == 0, r.stderr
