import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from strandflow.session import build_session

    conf = {"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4", "spark.driver.memory": "4g"}
    session = build_session("local[4]", "tests", **conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def compare(spark, sf_dir, queries, sql, name):
    """A query's rows against its SQL in DuckDB, in any order, floats to nine digits."""
    import duckdb

    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        c.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = queries[name](spark, sf_dir)
    cols = sorted(df.columns)
    plain = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    got = sorted((tuple(plain(r[x]) for x in cols) for r in df.collect()), key=repr)
    found = c.sql(sql[name])
    at = [found.columns.index(x) for x in cols]
    assert sorted(found.columns) == cols
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)
