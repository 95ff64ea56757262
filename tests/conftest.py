import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerflow.session import build_session
    spark = build_session("ledgerflow-tests", master="local[4]", shuffle_partitions=8)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerflow-test-"))
    yield spark
    spark.stop()


@pytest.fixture
def tmp_root(spark):
    from ledgerflow.session import scratch_path
    return scratch_path(spark, "test")
