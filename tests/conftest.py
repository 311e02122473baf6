import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import build_session

    spark = build_session(
        "local[4]",
        app_name="quarry-tests",
        shuffle_partitions=8,
        extra_conf={"spark.driver.memory": "8g"},
    )
    # Tests only: no shared folder is configured, so use a private one.
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-test-ckpt-"))
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def wh(spark):
    from quarry.sources.tables import Warehouse

    return Warehouse(spark, SF_SMOKE)
