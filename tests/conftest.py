from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import build_session, checkpoint_dir
    s = build_session(master="local[*]", shuffle_partitions=8)
    checkpoint_dir(s)   # unset in tests → a local scratch folder
    yield s
    s.stop()


@pytest.fixture(scope="session")
def wh_check(spark):
    from tillroll.plans.warehouse import Warehouse
    return Warehouse.for_source(spark, SF_CHECK)


@pytest.fixture(scope="session")
def duck_check():
    from tillroll.oracle.compare import duck_connection
    return duck_connection(SF_CHECK)
