"""Every registered query against its SQL, plan shape rules, and code rules."""

import math
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent
DATA = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
# the optional corpus operators have tests of their own
QUERIES = {k: q for k, q in entry.queries().items() if q.__module__.startswith("routeledger.catalog")}
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    return repr(round(v, 9)) if isinstance(v, float) else str(v)


def content(table):
    columns = sorted(table.column_names)
    data = table.select(columns).to_pydict()
    return columns, sorted(tuple(map(cell, r)) for r in zip(*[data[c] for c in columns]))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert name in SQL
    got = content(QUERIES[name](spark, DATA).toArrow())
    want = content(duck.execute(SQL[name]).to_arrow_table())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 40


def test_result_does_not_depend_on_partitions(spark):
    def run(n):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        return content(QUERIES["feed_supply_metrics"](spark, DATA).toArrow())
    one, many = run(1), run(13)
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert one == many


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"freshness_stream"}))
def test_plan_has_no_product(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_library_does_not_collect_tables():
    bounded = {"sinks.py": 1}
    for path in (ROOT / "routeledger").rglob("*.py"):
        if path.parent.name == "llm":
            continue
        text = path.read_text(encoding="utf-8")
        assert len(re.findall(r"\.collect\(\)", text)) == bounded.get(path.name, 0), path
        assert not re.search(r"toPandas\(|toLocalIterator|MAX_INLINE|localCheckpoint|crossJoin|\.rdd\b|F\.udf\(", text), path


def test_metrics_read_every_feed_table_once(spark):
    plan = QUERIES["feed_supply_metrics"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    # trips, windows, routes and exceptions are each cut from lineitem
    assert len(re.findall(r"FileScan parquet .*lineitem\.parquet", plan)) == 4
    assert len(re.findall(r"- Window ", plan)) == 1
