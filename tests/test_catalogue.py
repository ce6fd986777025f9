"""Each catalogue query against its SQL twin on the smallest tables."""

import duckdb
import pytest

from terraloom.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_twin(spark, db, name):
    got = catalogue.queries()[name](spark, SF).toPandas()
    want = db.sql(catalogue.oracle_sql()[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    got, want = (x[cols].sort_values(cols).reset_index(drop=True) for x in (got, want))
    assert len(got) == len(want)
    assert got.astype(str).equals(want.astype(str))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
