import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from fundlake.session import get_spark

    s = get_spark(
        master="local[4]",
        app="fundlake-tests",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g"},
    )
    yield s
    s.stop()
