"""Every registered query against its SQL, on the smallest data set."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from bowline.plans import catalog
from tests.conftest import DATA

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)
TYPES = {"INTEGER": "int", "BIGINT": "bigint", "BOOLEAN": "boolean", "DOUBLE": "double", "VARCHAR": "string"}
WITHOUT_SQL = {
    "train_softmax",
    "train_softmax_mlp",
    "train_softmax_sparse",
    "predict_softmax",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(frame.columns)
    plain = lambda v: None if pd.isna(v) else v
    rows = [tuple(plain(v) for v in row) for row in frame[names].astype(object).itertuples(index=False)]
    return names, sorted(rows, key=lambda row: [(v is None, v if v is not None else 0) for v in row])


def test_every_query_has_sql_or_a_reason():
    assert set(catalog.QUERIES) - set(catalog.ORACLE) == WITHOUT_SQL
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = driver.queries()[name](spark, DATA)
    expected = duck.sql(driver.oracle_sql()[name])
    types = {c: TYPES[str(t)] for c, t in zip(expected.columns, expected.types, strict=True)}
    assert dict(df.dtypes) == types
    got = canonical(df.toPandas())
    assert got == canonical(expected.df())
    assert got[1]


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_training_query_runs(spark, name):
    assert driver.queries()[name](spark, DATA).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0
