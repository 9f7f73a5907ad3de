"""Shared fixtures: one local session for the whole run."""

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablegate.session import build_session, ensure_checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
SF_BIG = "/root/testdata/sf0.1"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", app_name="tablegate-tests", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    # Tests only: use a scratch checkpoint folder when the session names none.
    ensure_checkpoint_dir(session, tempfile.mkdtemp(prefix="tablegate-ckpt-"))
    yield session
    session.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="tablegate-test-")
