"""The entry module where the optional part, or a library it uses, is absent."""

import subprocess
import sys

import pytest
from conftest import ROOT

CODE = """
import sys

class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in {names!r} or name in {names!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Absent())
import __spark_entry__ as E
print(len(E.queries()), len(E.oracle_sql()), any(k.startswith("op") for k in E.queries()))
"""


@pytest.mark.parametrize("names,warned", [(["ahocorasick"], True), (["corpus_pipeline"], False), (["clickpanes.llm"], False)])
def test_the_rest_works_without_the_optional_part(names, warned):
    from clickpanes.plans.catalog import QUERIES

    run = subprocess.run([sys.executable, "-c", CODE.format(names=names)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert run.stdout.split() == [str(len(QUERIES)), str(len(QUERIES)), "False"]
    assert ("training-data queries are left out" in run.stderr) == warned
