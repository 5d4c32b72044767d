from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("viewpulse-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("stage")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """A small table from rows and a DDL schema; timestamps may be given as text."""

    def build(ddl: str, rows: list[tuple]):
        names = [c.split()[0] for c in ddl.split(",")]
        types = dict(c.split() for c in ddl.split(","))
        text = {n: ("string" if t in ("timestamp_ntz", "date") else t) for n, t in types.items()}
        df = spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in text.items()))
        return df.selectExpr(*[f"CAST({n} AS {types[n]}) AS {n}" for n in names])

    return build
