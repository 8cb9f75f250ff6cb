import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from strata.session import get_session

    # Tests only: a cluster names its own warehouse (and checkpoint) folders.
    s = get_session("local[4]", "strata-tests", shuffle_partitions=4,
                    extra_conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="strata-warehouse-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's checkpoint folder."""
    from strata.session import scratch_dir

    return scratch_dir(spark, "test")
