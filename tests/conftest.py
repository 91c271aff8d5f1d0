import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from keepsake.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, app_name="keepsake-tests",
                    checkpoint_dir=tempfile.mkdtemp(prefix="keepsake-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="keepsake-test-")
