import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketry.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="basketry-tests")
    yield s
    s.stop()


def h(text: str) -> dt.datetime:
    """'yyyy-MM-dd HH' to a datetime."""
    return dt.datetime.strptime(text, "%Y-%m-%d %H")


@pytest.fixture
def make_beh(spark):
    """Typed behaviour rows from (user, item, code, 'yyyy-MM-dd HH')."""
    from basketry.schema import BEHAVIOUR_SCHEMA

    def build(rows):
        return spark.createDataFrame([(u, i, c, h(t)) for u, i, c, t in rows], BEHAVIOUR_SCHEMA)

    return build
