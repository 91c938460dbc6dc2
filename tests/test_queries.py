"""Every registered query against its SQL, on the smallest scale."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from compare import connect, rows_of

from __spark_entry__ import entry
from spendlake.catalog.oracle import ORACLE_SQL
from spendlake.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want
    assert want


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.endswith("_snapshots")])
def test_generated_code_can_be_jit_compiled(spark, name):
    """Methods above 8000 bytes stay interpreted."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan()
        debug = spark.sparkContext._jvm.org.apache.spark.sql.execution.debug
        code = getattr(getattr(debug, "package$"), "MODULE$").codegenString(plan)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000


def physical(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def test_merge_keeps_the_partitioning_of_its_batch(spark):
    assert physical(spark, "upsert_merge").count("Exchange") <= 4


def test_window_is_pushed_to_the_scan(spark):
    assert "GreaterThanOrEqual(date," in physical(spark, "date_window")


def test_a_lost_platform_is_an_error(spark, monkeypatch):
    from spendlake.catalog import queries

    def broken(df, root, name, at=None):
        if name == "meta_ads":
            raise OSError("disk is gone")
        return write(df, root, name, at)

    write = queries.write_snapshot
    monkeypatch.setattr(queries, "write_snapshot", broken)
    with pytest.raises(RuntimeError, match="meta_ads: disk is gone"):
        QUERIES["refined_snapshots"](spark, SF_DIR)
