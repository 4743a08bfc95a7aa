import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tsgrid.session import get_spark, checkpoint_dir
    s = get_spark("local[4]", shuffle_partitions=4,
                  extra={"spark.sql.adaptive.coalescePartitions.enabled": "true"})
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="tsgrid-test-")
