import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clinspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session("4", 4, "4g", str(tmp_path_factory.mktemp("stages")))


@pytest.fixture
def frame(spark):
    """Build a DataFrame from a schema string and rows."""

    def build(schema: str, *rows):
        return spark.createDataFrame(list(rows), schema)

    return build
