import duckdb
import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_its_sql(spark, con, name):
    result, _ = check.compare(
        spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF
    )
    assert result.startswith(("ok", "rows-only")), result


def test_smoke(spark):
    assert entry.entry(spark).count() > 0
