from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import listed
from tools.compare import TABLES, rows
from wardflow.plans import warehouse
from wardflow.plans.queries import Data
from wardflow.plans.silver import RECIPES

# One query of each family; tools/compare.py runs them all.
CHECKED = [
    "scan_csv",
    "sink_partitioned",
    "clean_dedup",
    "silver_patient",
    "silver_claim_items",
    "exists_flag",
    "join_asof_scd2",
    "surrogate_key",
    "scd2_doctor",
    "merge_upsert",
    "fact_visits",
    "fact_visits_two_loads",
    "upsert_evolve",
    "clean_fill_everything",
    "dq_foreign_key",
    "dq_outlier_iqr",
    "profile_columns",
    "load_metrics",
    "mart_hospital",
    "mart_operational",
    "summary_financial",
]


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    result = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, result.fetchall())


def test_registry_names():
    queries, oracles = set(contract.queries()), set(contract.oracle_sql())
    own = {q for q in queries if not (q == "pipeline" or re.match(r"op\d+_", q))}
    assert oracles <= queries and own - oracles == {"limit_any"}
    assert {f"silver_{name}" for name in RECIPES} <= queries


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_whole_lakehouse_twice(spark, lake, sf_dir):
    """Silver, dimensions, facts and marts from published tables; a second run changes no fact."""
    data = Data(spark, sf_dir)
    audit = warehouse.build_silver(lake, data.raw, "2024-07-01")
    assert {r.status for r in audit.collect()} == {"success"} and audit.count() == 22
    warehouse.build_dimensions(lake, "2024-07-01")
    # The study period of the test tables lies before the default watermark.
    control = spark.sql("SELECT n AS table_name, DATE '1998-01-01' AS last_loaded_date FROM VALUES ('fact_claims'), ('fact_visits'), ('fact_pharmacy') AS t(n)")
    lake.overwrite(warehouse.CONTROL, control)
    first = {r.table_name: r.last_loaded_date for r in warehouse.load_facts(lake, "2024-07-01").collect()}
    facts = {}
    for name, key, day in (("fact_claims", "claim_id", "claim_date"), ("fact_visits", "visit_id", "visit_date"), ("fact_pharmacy", "transaction_id", "transaction_date")):
        table = lake.table(name)
        assert table.count() == table.select(key).distinct().count() > 0
        assert first[name] == table.selectExpr(f"max({day})").first()[0]
        facts[name] = listed(table)
    warehouse.build_dimensions(lake, "2024-07-02")
    assert lake.table("dim_patient").filter("scd_version > 1").count() == 0
    warehouse.load_facts(lake, "2024-07-02")
    for name, before in facts.items():
        assert listed(lake.table(name)) == before
    marts = warehouse.build_marts(lake, "2024-07-01")
    assert {r.status for r in marts.collect()} == {"success"}
    assert lake.table("patient_analytics").columns[-1] == "created_at"
