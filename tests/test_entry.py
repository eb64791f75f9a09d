"""The driver's contract without the optional subpackage."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

from tripweave.plans import registry

ROOT = Path(__file__).resolve().parents[1]
BLOCK = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ImportError(name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()))
"""


def test_other_queries_stay_when_an_optional_import_fails():
    for names in (["public_tokenizers"], ["corpus_pipeline"], ["tripweave.llm"]):
        out = subprocess.run([sys.executable, "-c", BLOCK.format(names=names)], cwd=ROOT, capture_output=True, text=True, check=True)
        assert int(out.stdout.split()[0]) == len(registry.queries())
