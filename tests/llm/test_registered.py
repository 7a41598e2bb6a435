import glob
import os

import duckdb
import pytest

from routeledger.llm.queries import R

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(R.sql))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    want = con.sql(R.sql[name])
    columns = want.columns
    got = R.queries[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(want.fetchall())


def test_an_operator_each(spark):
    numbers = sorted(int(k[2:].split("_")[0]) for k in R.queries if k.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in R.queries
