"""Every query of the folder runs whole, and agrees with its SQL where it has some."""

import pytest

import __spark_entry__ as entry
import check
from molspark.llm import queries


@pytest.fixture(scope="module")
def con(sf):
    connection = check.connect(sf)
    yield connection
    connection.close()


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, con, sf, name):
    ok, message = check.compare(spark, con, name, sf)
    assert ok, message


def test_entry_stands_without_the_folder():
    """The rest imports when neither the folder nor the pipeline is there."""
    import subprocess
    import sys
    from pathlib import Path

    root = Path(entry.__file__).parent
    code = (
        "import importlib.util as u, sys; f = u.find_spec;"
        "u.find_spec = lambda n, p=None: None if 'llm' in n or n == 'corpus_pipeline' else f(n, p);"
        "import __spark_entry__ as e; q = e.queries();"
        "assert 'knn' in q and not [n for n in q if n.startswith('op') or n == 'pipeline'] and e.oracle_sql();"
        "assert not [m for m in sys.modules if m.startswith('molspark.llm')]"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
