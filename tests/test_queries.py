import os

import pytest

from auditlark.catalog import load_all
from compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(FOLDER), reason="needs the generated tables")
CATALOG = load_all()


@pytest.fixture(scope="module")
def sql():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_equals_its_sql(spark, sql, name):
    problem, _ = compare(spark, sql, CATALOG[name], FOLDER)
    assert problem is None, problem


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
