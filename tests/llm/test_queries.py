import re

import duckdb
import pytest

import __spark_entry__ as contract
from tools.compare import rows
from wardflow.llm.oracles import ORACLES
from wardflow.llm.queries import QUERIES


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'")
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, result.fetchall())
