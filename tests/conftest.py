import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from paysheaf.session import get_spark
    s = get_spark("local[4]", 4, app_name="paysheaf-tests")
    from paysheaf.session import checkpoint_dir
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="paysheaf-test-")
