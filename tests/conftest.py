import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)
sys.path[:0] = [HERE, ROOT]
# The Python workers import the package too, wherever the tests are started.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark():
    from ehrspark.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()
