import os

import pytest

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def sf_small():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def sf_large():
    return f"{TESTDATA}/sf0.1"
