import os
import shutil
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from retail_lakehouse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="rl-checkpoints-")
    s = build_session("local[4]", 4, app_name="retail_lakehouse_tests", checkpoint_dir=folder)
    yield s
    s.stop()
    shutil.rmtree(folder, ignore_errors=True)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="rl-test-")
