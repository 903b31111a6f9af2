import glob
import os

import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g"}
    s = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return db
