"""The entry point without its optional part."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

BLOCKED = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:len({name!r}.split("."))] == {name!r}.split("."):
            raise ModuleNotFoundError(f"no {{name}}", name=name)
sys.meta_path.insert(0, Block())
sys.path.insert(0, {root!r})
import __spark_entry__ as e
names = set(e.queries())
assert not any(n.startswith("op") and n[2].isdigit() for n in names) and "pipeline" not in names
assert len(names) > 60 and set(e.oracle_sql()) <= names
"""


@pytest.mark.parametrize("name", ["quill.llm", "corpus_pipeline"])
def test_core_queries_stay_without_the_training_data_part(name):
    subprocess.run([sys.executable, "-c", BLOCKED.format(name=name, root=ROOT)], check=True, timeout=120)


def test_a_package_only_the_part_needs_may_be_missing():
    if not os.path.isdir(os.path.join(ROOT, "quill", "llm")):
        pytest.skip("the part is not here")
    run = subprocess.run([sys.executable, "-c", BLOCKED.format(name="ahocorasick", root=ROOT)], timeout=120, stderr=subprocess.PIPE, text=True)
    assert run.returncode == 0 and "ahocorasick" in run.stderr


def test_a_broken_library_is_an_error():
    run = subprocess.run([sys.executable, "-c", BLOCKED.format(name="quill.operators.index", root=ROOT)], timeout=120, capture_output=True)
    assert run.returncode != 0
