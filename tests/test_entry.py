"""The driver's entry points, with and without the training-data subpackage."""

import os
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.abspath(entry.__file__))


def test_flagship_returns_rows(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_library_works_without_the_subpackage():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, *a):\n"
        "        if name == 'corpus_pipeline' or name.startswith('tessera.llm'):\n"
        "            raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not [q for q in e.queries() if q.startswith('op1_') or q == 'pipeline']\n"
        "assert not [m for m in sys.modules if m.startswith('tessera.llm')]\n"
    )
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=False).returncode == 0


def test_nothing_else_imports_the_subpackage():
    for folder, _, names in os.walk(os.path.join(ROOT, "tessera")):
        for name in names:
            if name.endswith(".py") and "llm" not in folder.split(os.sep):
                with open(os.path.join(folder, name)) as f:
                    assert "tessera.llm" not in f.read(), name
