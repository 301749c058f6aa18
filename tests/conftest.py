import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import checkpoint_root, local_session  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, shuffle_partitions=8)
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "landed")
