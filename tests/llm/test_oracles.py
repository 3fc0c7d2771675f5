import duckdb
import pytest

from tidegrid.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = registry.queries()[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
