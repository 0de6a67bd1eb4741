import glob
import os
import sys
import tempfile

import duckdb
import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    tmp = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    builder = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.driver.memory", "6g")
    session = builder.config("spark.checkpoint.dir", tmp).config("spark.local.dir", tmp).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def table_of(df):
    """Rows as sorted text, columns by name, floats to nine digits."""
    df = df[sorted(df.columns)].astype(object)
    rows = [tuple("~" if pd.isna(v) else f"{v + 0.0:.9g}" if isinstance(v, float) else str(v) for v in r) for r in df.itertuples(index=False)]
    return list(df.columns), sorted(rows)


@pytest.fixture(scope="session")
def same(spark, duck):
    def check(run, sql):
        assert table_of(run(spark, SF).toPandas()) == table_of(duck.execute(sql).df())

    return check
