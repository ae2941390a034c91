import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from patronlens.workspace import build_session, clear_workspace  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]", "patronlens-tests",
        **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="patronlens-tests-"), "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_workspace(session)
    session.stop()


@pytest.fixture
def many_partitions(spark):
    """Keep small shuffles apart, so that partition offsets matter."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
