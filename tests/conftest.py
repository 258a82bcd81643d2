import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return build_session("8", "tests")


@pytest.fixture(scope="session")
def small_dir():
    return "/root/testdata/sf0.001"
