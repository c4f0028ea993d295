import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from blockpulse.session import local_session

    session = local_session("4", "blockpulse-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL


@pytest.fixture(scope="session")
def oracle(sf) -> duckdb.DuckDBPyConnection:
    from check_oracle import oracle_connection

    return oracle_connection(sf)
