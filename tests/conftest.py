import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def middle():
    return MIDDLE


@pytest.fixture(scope="session")
def same(spark):
    """Compares a query with its SQL on a folder of tables, whatever the order of rows."""
    import duckdb

    tables = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

    def rows(frame, columns):
        value = lambda v: "~" if v is None or v != v else repr(float(v)) if hasattr(v, "dtype") or isinstance(v, int | float) else str(v)
        return sorted(tuple(value(v) for v in row) for row in frame[columns].itertuples(index=False))

    def compare(query, sql, folder):
        db = duckdb.connect()
        for t in tables:
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
        ours, theirs = query(spark, folder).toPandas(), db.execute(sql).df()
        columns = sorted(ours.columns)
        assert columns == sorted(theirs.columns)
        assert rows(ours, columns) == rows(theirs, columns)
        return len(ours)

    return compare
