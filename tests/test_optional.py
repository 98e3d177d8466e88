"""Without a package that only the corpus queries need, all others are registered."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

SCRIPT = """
import sys, warnings
sys.path.insert(0, {repo!r})
sys.modules[{missing!r}] = None
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__ as entry
own = entry.own_queries()
assert entry.queries().keys() == own.keys() == entry.oracle_sql().keys(), len(entry.queries())
assert any("left out" in str(w.message) for w in said)
print(len(own))
"""


@pytest.mark.parametrize(
    "missing", ["regex", "xxhash", "tokenizers", "public_tokenizers", "numpy", "pyarrow", "corpus_pipeline", "ratewatch.llm"]
)
def test_missing_packages(missing):
    repo = str(Path(__file__).parent.parent)
    ended = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo, missing=missing)], capture_output=True, timeout=120)
    assert ended.returncode == 0, ended.stderr.decode()[-1500:]
    assert int(ended.stdout) >= 45
