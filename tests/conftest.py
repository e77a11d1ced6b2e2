import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers must find the package as well.
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from alarmloom.session import local_session

    session = local_session(cores=8, shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SF_SMALL
