"""Every registered query against its SQL, or its row count where SQL has no twin."""

import pytest

from checks import ORACLES, QUERIES
from checks.compare import compare


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, sf_dir, name):
    rows, problem = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
    assert problem is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
