import os
import sys

import pytest

_HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(_HERE), _HERE]
# The models and decoders of the tests live in test modules, which the Python workers must find.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [_HERE, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark():
    from speechlake.session import local_session

    session = local_session(8)
    yield session
    session.stop()
