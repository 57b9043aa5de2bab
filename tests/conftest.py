import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from rentmart.session import build_session
    s = build_session(cpus=4, extra={"spark.sql.shuffle.partitions": "8",
                                     "spark.driver.memory": "4g"})
    yield s
    s.stop()
