import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    return DATA


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.fixture
def same(spark, sf_dir, duck):
    """Assert that a query and its SQL give the same rows, whatever their order, in the same types."""
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date"}

    def check(query, sql):
        df = query(spark, sf_dir)
        got = duck.execute(sql)
        names = [c[0] for c in got.description]
        assert sorted(names) == sorted(df.columns)
        assert {c[0]: kinds.get(str(c[1]), str(c[1])) for c in got.description} == dict(df.dtypes)
        show = lambda v: repr(v + 0.0) if isinstance(v, float) else str(v)
        a = sorted(tuple(show(r[c]) for c in sorted(names)) for r in df.collect())
        b = sorted(tuple(show(r[names.index(c)]) for c in sorted(names)) for r in got.fetchall())
        assert a == b

    return check
