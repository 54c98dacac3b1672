import os

import duckdb
import pytest
from pyspark.sql import functions as F

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck():
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return db


@pytest.fixture
def crowded():
    """Adds columns whose names clash with what an operator might use for itself."""

    def add(df):
        for name in ("n", "size", "kept", "_id", "_text", "_word", "_h", "component_id", "tokens"):
            if name not in df.columns:
                df = df.withColumn(name, F.lit(name))
        return df

    return add
