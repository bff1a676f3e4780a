import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from kenning.session import build_session
    return build_session("local[4]", 4, extra={"spark.driver.memory": "6g"})


@pytest.fixture(scope="session")
def fx_paths():
    import fixtures as FX
    return FX.write_all(tempfile.mkdtemp(prefix="kenning-fx-", dir="/tmp"))
