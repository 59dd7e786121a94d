import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from skein.session import local_session

    session = local_session("tests", cores=4, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
