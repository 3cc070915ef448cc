import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stellate.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # catalog tables (bucketed snapshots) keep their data under the test's
    # own warehouse folder, never in the working directory
    s = get_spark("local[4]", shuffle_partitions=8,
                  extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="stellate-wh-")})
    # tests own their scratch space; on a cluster spark.checkpoint.dir is set
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stellate-test-"))
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def no_views_left(request):
    """Temporary views of one module's tests are not seen by the next's."""
    yield
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    if s is not None:
        for t in s.catalog.listTables():
            if t.isTemporary:
                s.catalog.dropTempView(t.name)


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from stellate.sources.testdata import TABLES
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con
