import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from rehome.session import checkpoint_root, get_spark
    s = get_spark("local[4]", shuffle_partitions=4, app="rehome-tests")
    checkpoint_root(s)
    yield s
    s.stop()
