"""Registered queries against DuckDB on the smallest test tables, and plans."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from checks import suite
from checks.verify import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

@pytest.fixture(scope="module")
def sql():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(suite.ORACLES))
def test_matches_sql(spark, sql, name):
    assert compare(spark, sql, SF, name).startswith("ok ")


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(suite.QUERIES) - set(suite.ORACLES) == {"file_digests"}


def physical(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_examples_are_limited_before_the_shuffle(spark):
    plan = physical(spark, "violation_examples")
    shuffled = plan[plan.index("Exchange hashpartitioning(check"):]
    assert "WindowGroupLimit" in shuffled.split("\n", 2)[1] + shuffled.split("\n", 3)[2]


def test_pairs_come_from_equi_joins(spark):
    plan = physical(spark, "near_dup_review")
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "LeftAnti" in plan


def test_a_column_report_reads_only_its_columns(spark):
    plan = physical(spark, "document_text_format")
    assert "ReadSchema: struct<text:string>" in plan or "struct<doc_id:bigint,text:string>" in plan


def test_the_cleaned_review_leaves_out_no_block(spark, tmp_path):
    """150 customers with one title: a title block above the published limit."""
    tables = {
        "customer": ([(4000 + k, f"Customer#{k:09d}", 0, 10.0, "FURNITURE") for k in range(150)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "nation": ([(0, "NATION_0", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "AFRICA")], "r_regionkey int, r_name string"),
        "part": ([(4000 + k, "large ring", "Brand#7", "LARGE", 7) for k in range(150)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
    }
    con = duckdb.connect()
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    found = entry.queries()["clean_review"](spark, str(tmp_path))
    assert found.count() > 1000
    assert compare(spark, con, str(tmp_path), "clean_review").startswith("ok ")
    assert "s.n <=" not in entry.oracle_sql()["clean_review"] and "s.n <= 80" in entry.oracle_sql()["near_dup_review"]
