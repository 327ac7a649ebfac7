"""Every registered query against its SQL on DuckDB, at the smallest scale."""

from pathlib import Path

import pytest

import catalog

duckdb = pytest.importorskip("duckdb")

from tools.check_oracle import rows_of  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in sorted(Path(SMALL).glob("*.parquet")):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query(spark, con, name):
    df = catalog.QUERIES[name](spark, SMALL)
    res = con.execute(catalog.ORACLE[name])
    assert rows_of(df.columns, df.collect()) == rows_of([c[0] for c in res.description], res.fetchall())
