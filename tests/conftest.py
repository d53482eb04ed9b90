import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from dimweave.session import build_session

    ckpt = tempfile.mkdtemp(prefix="dimweave-test-ckpt-")
    warehouse = tempfile.mkdtemp(prefix="dimweave-test-wh-")
    s = build_session(
        "local[4]",
        app="dimweave-tests",
        shuffle_partitions=4,
        conf={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": warehouse},
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from dimweave.sources.tables import Tables

    return Tables(spark, SF_SMALL)


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="dimweave-test-")
