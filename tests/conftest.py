"""A session for all tests, and DuckDB views over the smallest tables."""

from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    work = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.warehouse.dir", f"{work}/warehouse").config("spark.local.dir", work).config("spark.checkpoint.dir", f"file://{work}/shared").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        source = str(path) if path.is_file() else f"{path}/*.parquet"
        con.sql(f"create view {path.stem} as select * from '{source}'")
    return con


def same_rows(spark, duck, df, sql: str, where: str) -> None:
    """The Spark rows and DuckDB's are the same, by sorted column names."""
    df.write.parquet(where)
    duck.execute(f"create or replace temp table got as select * from '{where}/*.parquet'")
    duck.execute(f"create or replace temp table want as {sql}")
    names = [sorted(r[0] for r in duck.sql(f"describe {t}").fetchall()) for t in ("got", "want")]
    assert names[0] == names[1]
    columns = ", ".join(f'"{c}"' for c in names[0])
    for a, b in (("got", "want"), ("want", "got")):
        assert duck.sql(f"select {columns} from {a} except all select {columns} from {b} limit 3").fetchall() == []
