from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vitrail.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=8, app_name="vitrail-tests")
    yield session
    session.stop()


@pytest.fixture
def workdir(tmp_path):
    """Per-test folder for hand-made input files."""
    return tmp_path
