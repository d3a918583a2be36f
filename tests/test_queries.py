"""Every registered query against its SQL."""

import subprocess
import sys
from pathlib import Path

import pytest

from checks.compare import compare, duck
from checks.oracles import ORACLES
from checks.queries import QUERIES
from tests.conftest import SF

@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    outcome = compare(spark, con, SF, name)
    assert outcome.startswith("ok"), outcome


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() == 1
    added = set(driver.queries()) - set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and all(n.startswith("op") or n == "pipeline" for n in added)


def test_entry_without_the_training_data_operators():
    """The entry loads, with the other queries, when the folder or a package that it needs is not there."""
    hide = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.split('.')[0] == GONE or name == GONE or name.startswith(GONE + '.'):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert not any(n.startswith('op') for n in e.queries()) and 'got_value' in e.queries() and set(e.oracle_sql()) == set(e.queries())\n"
    )
    root = Path(__file__).resolve().parents[1]
    for gone in ("footfall.llm", "ahocorasick", "public_tokenizers"):
        ran = subprocess.run([sys.executable, "-c", f"GONE = {gone!r}\n{hide}"], cwd=root, capture_output=True, text=True, timeout=120)
        assert ran.returncode == 0, ran.stderr[-800:]
