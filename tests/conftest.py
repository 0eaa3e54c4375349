"""One local session, and the comparison of a query with its SQL."""

from __future__ import annotations

import glob
import os
import sys
from collections import Counter

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("TESTDATA_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("sievebed-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def oracle():
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


SQL_TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="session")
def assert_same():
    def check(frame, relation):
        ours = {name: SQL_TYPES[kind] for name, kind in frame.dtypes}
        assert ours == dict(zip(relation.columns, map(str, relation.types), strict=True))
        ours = _bag(frame.columns, map(tuple, frame.collect()))
        theirs = _bag(relation.columns, relation.fetchall())
        assert sum(ours.values()) == sum(theirs.values())
        assert ours == theirs

    return check
