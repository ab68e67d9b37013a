import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from touchline.checks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def records(spark):
    """Rows with the JSON text of each given object (or the text itself) in ``record``."""

    def make(*items):
        texts = [(i if isinstance(i, str) else json.dumps(i),) for i in items]
        return spark.createDataFrame(texts, "record string")

    return make
