"""One Spark session for all tests, and the comparison of a query with its DuckDB equivalent."""

from __future__ import annotations

import math
import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    folder = tmp_path_factory.mktemp("spark")
    conf = {"spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.checkpoint.dir": f"file://{folder}/shared", "spark.sql.warehouse.dir": f"{folder}/warehouse", "spark.local.dir": f"{folder}/local"}
    session = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def plain(v):
    """A value as both engines are compared by: floats to nine digits, nested ones as tuples."""
    if v is None or isinstance(v, (bool, str, int)):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    return str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=lambda r: [(x is None, str(x)) for x in r])


@pytest.fixture(scope="session")
def same_as_duck(spark, duck):
    def check(query, sql):
        df = query(spark, SMALL)
        rel = duck.sql(sql)
        ours, theirs = table(df.columns, df.collect()), table(rel.columns, rel.fetchall())
        assert ours[0] == theirs[0]
        assert len(ours[1]) == len(theirs[1])
        assert ours[1] == theirs[1]

    return check
