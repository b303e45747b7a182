"""The entry without what is optional."""

import subprocess
import sys
from pathlib import Path

import pytest

CODE = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
from contract.queries import QUERIES
assert set(QUERIES) <= set(entry.queries()) and len(QUERIES) > 80
assert not [q for q in entry.queries() if q.startswith("op") and q[2].isdigit()], "optional queries"
"""


@pytest.mark.parametrize("name", ["public_tokenizers", "modtally.llm"])
def test_the_other_queries_stay(name):
    subprocess.run([sys.executable, "-c", CODE.format(name=name)], cwd=Path(__file__).parents[1], check=True, timeout=120)


def test_errors_of_own_modules_go_through():
    done = subprocess.run([sys.executable, "-c", CODE.format(name="modtally.session")], cwd=Path(__file__).parents[1], capture_output=True, timeout=120)
    assert done.returncode and b"modtally.session" in done.stderr
