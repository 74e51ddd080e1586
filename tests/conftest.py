from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cascara.session import local_session

    s = local_session(shuffle_partitions=8, app="cascara-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def churn01(spark):
    """The raw churn stand-in at sf0.01 (1,550 rows)."""
    from cascara.catalog.q_clean import raw

    return raw(spark, SF01)
