import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from qaspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = build_session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": shared}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    def collect(df, *order):
        return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]

    return collect
