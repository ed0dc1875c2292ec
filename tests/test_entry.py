"""The entry module works with and without the optional subpackage."""

import subprocess
import sys

import pytest

from conftest import ROOT


@pytest.mark.parametrize("gone", [("docmill.llm", "corpus_pipeline"), ("xxhash",), ("numpy.nowhere", "docmill.llm")])
def test_imports_without_optional_parts(gone):
    code = (
        f"import sys\nGONE = {gone!r}\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(GONE): raise ModuleNotFoundError(name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not [q for q in e.queries() if q.startswith('op')]\n"
        "assert set(e.oracle_sql()) <= set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_nothing_else_imports_the_subpackage():
    found = subprocess.run(["grep", "-rlE", "llm", "docmill", "--include=*.py"], cwd=ROOT, capture_output=True, text=True).stdout.split()
    assert all(f.startswith("docmill/llm/") for f in found)
