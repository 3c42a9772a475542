import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from vellum.session import DEFAULT_CONF, ensure_checkpoint_dir
    builder = (SparkSession.builder.master("local[*]").appName("vellum-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", "6g"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vellum-test-ckpt-"))
    ensure_checkpoint_dir(session)
    from vellum.session import ship_package
    ship_package(session)
    yield session


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def values(df, col):
    return [r[col] for r in df.collect()]
