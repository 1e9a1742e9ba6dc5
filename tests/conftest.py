import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

import oracle  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return oracle.session()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
