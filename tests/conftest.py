import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TESTS = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
sys.path.insert(0, TESTS)
# Python workers start from the JVM's environment: let them import test-local
# helper classes (fake model clients) as well.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, TESTS, os.environ.get("PYTHONPATH", "")])

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from readerflow.session import local_session

    s = local_session(8, shuffle_partitions=8, app="readerflow-tests")
    yield s
    s.stop()


@pytest.fixture
def tmpdir_fresh(tmp_path):
    return str(tmp_path)
