import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from webmetrics.session import checkpoint_dir, get_spark
    wh = tempfile.mkdtemp(prefix="webmetrics-warehouse-")
    s = get_spark("local[4]", app="webmetrics-tests", shuffle_partitions=4,
                  extra={"spark.sql.warehouse.dir": wh})
    checkpoint_dir(s)
    yield s
    s.stop()
