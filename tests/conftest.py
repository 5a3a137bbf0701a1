"""One small Spark session and the comparison of a query with its SQL."""

from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).resolve().parents[1]), os.environ.get("PYTHONPATH", "")])

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="spark-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in sorted(Path(SF_DIR).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p / '*.parquet' if p.is_dir() else p}')")
    return con


def rows(df: DataFrame) -> list[str]:
    return sorted(repr(sorted(r.asDict(recursive=True).items())) for r in df.collect())


@pytest.fixture(scope="session")
def same(spark, duck):
    """Asserts that a query and its SQL give the same columns and rows."""

    def check(query, sql: str) -> None:
        got, want = query(spark, SF_DIR), duck.sql(sql)
        assert sorted(got.columns) == sorted(want.columns)
        expected = sorted(repr(sorted(zip(want.columns, r))) for r in want.fetchall())
        assert rows(got) == expected

    return check
