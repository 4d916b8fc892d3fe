from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardflow.session import build_session  # noqa: E402
from wardflow.session import fresh_path  # noqa: E402
from wardflow.sinks.store import TableStore  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={
            "spark.driver.memory": "3g",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, request):
    name = "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name)[:60]
    return TableStore(spark, fresh_path(spark, "lake"), name)


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def listed(df, *columns):
    """Rows as sorted tuples of the given columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)
