import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from codesieve.session import local_session

    return local_session(4, "6g")


@pytest.fixture(scope="session")
def small():
    return SMALL
