"""Every query with SQL gives the rows of that SQL."""

import pytest

from foliant.plans import catalogue
from tests.conftest import DATA, same_rows


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_same_rows(spark, oracle, name):
    columns, rows = oracle(catalogue.ORACLE_SQL[name], "sf0.001")
    same_rows(catalogue.QUERIES[name](spark, f"{DATA}/sf0.001"), columns, rows)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_runs(spark, name):
    assert catalogue.QUERIES[name](spark, f"{DATA}/sf0.001").count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
