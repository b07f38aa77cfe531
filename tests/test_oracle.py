"""Every query against its SQL in DuckDB: names, types and values."""


import duckdb
import pytest

from tallyspan.plans import ORACLES, QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings"]
SAME_TYPE = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    yield connection
    connection.close()


def in_order(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    result = result.select(*columns)
    got = in_order(tuple(r) for r in result.collect())
    assert got
    if name not in ORACLES:
        return
    expected = duck.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})")
    assert sorted(duck.sql(ORACLES[name]).columns) == columns
    assert [SAME_TYPE[t] for _, t in result.dtypes] == [str(t) for t in expected.types]
    assert got == in_order(expected.fetchall())


def test_every_query_has_sql_or_says_why():
    for name, function in QUERIES.items():
        assert "Provisional P" in function.__doc__
        assert name in ORACLES
