"""Every registered query with SQL, on the smallest tables, against DuckDB."""

import importlib
import math
import os

import duckdb
import pytest

from laptrace.plans.catalog import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def clean(value):
    return None if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    entry = importlib.import_module("__spark_entry__")
    found = entry.queries()[name](spark, SF_DIR)
    columns = sorted(found.columns)
    want = duck.sql(SQL[name])
    assert columns == sorted(want.columns)
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = sorted(repr(tuple(map(clean, r))) for r in duck.sql(f"select {listed} from want").fetchall())
    got = sorted(repr(tuple(map(clean, r))) for r in found.select(*[f"`{c}`" for c in columns]).collect())
    assert got == expected


def test_entry(spark):
    entry = importlib.import_module("__spark_entry__")
    found = entry.entry(spark)
    assert found.columns == ["name", "event", "course", "age", "time_seconds"] and found.count() > 0


# Plans of the pure DataFrame queries that carry the load.
PLANNED = ["fastest_by_age__e1", "age_at_race__d1", "wide_features__b2", "event_indicators__b10", "race_rows__j8",
           "clean_names__j7", "page_links__j1", "stratified_split__f5", "class_weights__k8", "best_event_label__k1",
           "progression_impute__k3", "feature_vocabulary__d8", "eval_metrics__e12"]


@pytest.mark.parametrize("name", PLANNED)
def test_plans_stay_native(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_scan_reads_only_what_it_needs(spark):
    plan = QUERIES["fastest_by_age__e1"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in plan and "l_orderkey" not in plan and "PushedFilters" in plan


def test_partitions_do_not_change_results(spark):
    def run(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            return [sorted(map(tuple, QUERIES[n](spark, SF_DIR).collect()), key=repr)
                    for n in ("fastest_by_age__e1", "stratified_split__f5", "median_impute__e7_orders")]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)

    assert run(1) == run(8)
