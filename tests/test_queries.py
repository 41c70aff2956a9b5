"""Every registered query against its checking SQL, on the smallest given tables."""

from pathlib import Path

import pytest

from verification.compare import connect, difference
from verification.oracle import oracle_sql
from verification.queries import REGISTERED, Tables

SF_DIR = "/root/testdata/sf0.001"
CHECKS = oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def tables(spark):
    """Steps that many queries share are staged once."""
    return Tables(spark, SF_DIR).stage("with_factors", "outlook", "addon", "raw", "frm")


@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    assert set(CHECKS) == set(REGISTERED)


@pytest.mark.parametrize("name", REGISTERED)
def test_query(tables, sql, name):
    assert difference(REGISTERED[name](tables).toPandas(), sql.execute(CHECKS[name]).df()) == ""
