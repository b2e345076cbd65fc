import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import get_session

    s = get_session(os.environ.get("TEST_MASTER", "local[4]"), **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="quarry-test-"))
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from quarry.sources.files import TEST_TABLES

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
