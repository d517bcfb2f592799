"""Every registered query against its SQL, on whole tables."""

import pytest

from catalog import load_all
from tools.check import compare, connect

ENTRIES = load_all()


@pytest.fixture(scope="module")
def con(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", list(ENTRIES))
def test_query(spark, sf_dir, con, name):
    entry = ENTRIES[name]
    df = entry.run(spark, sf_dir)
    assert entry.sql, "every query here has its SQL"
    assert compare(df, con, entry.sql) == ""


def test_entry_points(spark):
    import __spark_entry__ as contract

    assert set(ENTRIES) <= set(contract.queries()) and set(ENTRIES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns[0] == "book_id"
