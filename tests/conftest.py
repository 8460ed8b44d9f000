import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quillpair.session import local_session
    s = local_session("4", shuffle_partitions=4, app="quillpair-tests", scan_partitions=4,
                      shared_dir=tempfile.mkdtemp(prefix="quillpair-tests-"))
    yield s


def one_col(spark, values, name="t"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id bigint, {name} string")
