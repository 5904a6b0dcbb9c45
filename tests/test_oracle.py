"""Every query with an oracle equals its DuckDB SQL on the sf0.001 tables
(rows, column names, order-insensitive values; floats to 6 places)."""

import duckdb
import pytest

from basketry.plans import registry
from tools.check_oracle import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_oracle(spark, con, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    want = con.sql(registry.ORACLES[name]).df()
    assert compare(got, want) == "OK"
