import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import os

    os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"     # for the Python workers
    from docsift.session import local_session

    s = local_session(4, 4, app="docsift-llm-tests")
    yield s
    s.stop()
