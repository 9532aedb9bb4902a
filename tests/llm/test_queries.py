import pytest

from checks.compare import compare
from skylag.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)[1] is None
