from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sheaf.session import build_session

    session = build_session("local[4]", app_name="sheaf-tests", shuffle_partitions=4)
    yield session
    session.stop()


def needs(path: str):
    return pytest.mark.skipif(not os.path.exists(path), reason=f"{path} not available")
