import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from brinkcast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        8,
        "brinkcast-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="brinkcast-tests-"),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture()
def rows():
    """Collect as a sorted list of tuples."""

    def get(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return get
