"""The registry can be read before any session exists and without the optional operators; every oracle belongs to a query."""
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
LISTED = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and set(e.oracle_sql()) <= set(q)"


def _runs(code: str) -> bool:
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT).returncode == 0


def test_queries_are_listed_without_a_session():
    assert _runs(LISTED)


@pytest.mark.parametrize("absent", ["feedyard.llm", "feedyard.llm.queries", "xxhash", "zstandard", "public_tokenizers"])
def test_core_queries_are_listed_without_the_optional_operators(absent):
    hidden = f"import sys; sys.modules[{absent!r}] = None; " + LISTED
    assert _runs(hidden + "; assert not [k for k in q if k.startswith('op') and k[2].isdigit()] and 'pipeline' not in q and 'adjudicate' in q")
