import os
import tempfile

import duckdb
import pytest

SMOKE = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def workers(spark):
    """Python workers find the package wherever pytest was started."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment["PYTHONPATH"] = root
    return spark


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="dl-llm-", dir="/tmp")
