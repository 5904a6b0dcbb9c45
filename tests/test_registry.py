"""Every registered query runs on sf0.001 and keeps a stable schema;
the entry point returns the training set."""

import pytest

import __spark_entry__ as entry
from basketry.plans import registry


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 610
    assert df.columns == ["user_id", "item_id", "time1", "type_1count", "time2", "type_2count", "time3", "type_3count", "type_4count", "label"]


def test_oracles_are_subset_of_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_runs_sf0001(spark, name):
    df = entry.queries()[name](spark, "/root/testdata/sf0.001")
    df.count()
    assert len(df.columns) == len(set(df.columns))
