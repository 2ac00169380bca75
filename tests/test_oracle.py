"""Every query of the package outside the corpus part against its SQL, or for rows where it has none."""

from __future__ import annotations

import pytest

from oracle import compare
from tallyroad.plans import core, extra, models, more
from tests_env import SF

QUERIES = core.queries() | extra.queries() | more.queries() | models.queries()
SQL = core.oracle_sql() | extra.oracle_sql() | more.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    assert compare(spark, SF, QUERIES[name], SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 7
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
