"""Every query of the subpackage with SQL equals DuckDB on the sf0.001 tables."""

import pytest

from basketry.llm import registry
from tools.check_oracle import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_oracle(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    assert len(got)
    assert compare(got, duck.sql(registry.ORACLES[name]).df()) == "OK"
