"""What the entry offers when the subpackage of text operators is there, absent or broken."""

import os
import shutil
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def copy(work):
    for name in ("feedloom", "__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.isdir(f"{HERE}/{name}"):
            shutil.copytree(f"{HERE}/{name}", f"{work}/{name}", ignore=shutil.ignore_patterns(
                "__pycache__", "llm"))
        elif name != "corpus_pipeline.py" and os.path.exists(f"{HERE}/{name}"):
            shutil.copy(f"{HERE}/{name}", work)
    return work


def offered(folder):
    told = subprocess.run(
        [sys.executable, "-B", "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
        cwd=folder, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": folder})
    return told.returncode, told.stdout.split(), told.stderr


def put(folder, name, text):
    os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write(text)


def subpackage(folder, queries, pipeline="from feedloom.llm.queries import QUERIES\nrun = QUERIES['op0']\nORACLE_SQL = None\n"):
    put(folder, "feedloom/llm/__init__.py", "")
    put(folder, "feedloom/llm/queries.py", queries)
    put(folder, "corpus_pipeline.py", pipeline)


def core():
    from feedloom.plans.checks import CHECKS
    return len(CHECKS)


def test_without_the_subpackage(copy):
    assert offered(copy)[:2] == (0, [str(core())] * 2)


def test_only_its_leftovers(copy):
    put(copy, "feedloom/llm/__pycache__/queries.pyc", "")
    put(copy, "corpus_pipeline.py", "import feedloom.llm.common\n")
    assert offered(copy)[:2] == (0, [str(core())] * 2)


def test_with_the_subpackage(copy):
    subpackage(copy, "QUERIES = {'op0': len}\nSQL = {}\n")
    assert offered(copy)[:2] == (0, [str(core() + 2), str(core())])


@pytest.mark.parametrize("wrong", [
    "import feedloom.llm.nothing", "from feedloom.llm import nothing", "from feedloom.schemas import nothing", "import feedloom.nothing"])
def test_a_wrong_import_within_it_is_not_hidden(copy, wrong):
    subpackage(copy, f"{wrong}\nQUERIES = {{'op0': len}}\nSQL = {{}}\n")
    code, _, error = offered(copy)
    assert code and "nothing" in error


def test_a_library_that_is_not_installed_leaves_the_core(copy):
    subpackage(copy, "import a_library_of_nobody\nQUERIES = {'op0': len}\nSQL = {}\n")
    code, counts, error = offered(copy)
    assert (code, counts) == (0, [str(core())] * 2) and "a_library_of_nobody" in error
