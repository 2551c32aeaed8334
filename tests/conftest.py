import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paths import DATA, ROOT  # noqa: E402

sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from regalign.session import local_session

    s = local_session("*", shuffle_partitions=8, app="regalign-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sources(spark):
    from regalign.sources.delimited import FINANCIAL_SCHEMA, SUPPLY_CHAIN_SCHEMA, read_delimited

    s1 = read_delimited(spark, os.path.join(DATA, "source1.csv"), SUPPLY_CHAIN_SCHEMA)
    s2 = read_delimited(spark, os.path.join(DATA, "source2.csv"), FINANCIAL_SCHEMA)
    return s1, s2
