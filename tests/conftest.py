from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def normal(row) -> tuple:
    return tuple(round(v, 6) if isinstance(v, float) else v for v in row)


def compare(spark, name: str, run, sql: str, data: str = DATA) -> None:
    """The query's rows against DuckDB's, as multisets, columns by name."""
    import duckdb

    con = duckdb.connect()
    for t in os.listdir(data):
        con.execute(f"create view {t.split('.')[0]} as select * from read_parquet('{data}/{t}')")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    df = run(spark, data)
    assert sorted(df.columns) == sorted(names), name
    got = [normal(r) for r in df.select(*sorted(names)).collect()]
    want = [normal([r[names.index(c)] for c in sorted(names)]) for r in expected]
    assert sorted(map(repr, got)) == sorted(map(repr, want)), f"{name}: {set(map(repr, got)) ^ set(map(repr, want))}"[:2000]
