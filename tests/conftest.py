"""One session for all tests."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from weftgraph.session import session

    found = session("local[4]", 4, "tests", **{"spark.driver.memory": "3g"})
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()
