import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ.setdefault("PYTHONPATH", str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from patraloom.session import local_session, ship

    session = local_session("tests", 4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    ship(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
