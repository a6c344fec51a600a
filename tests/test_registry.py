"""Every registered query against its SQL on the smallest tables."""

import os
import shutil
import subprocess
import sys

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables not present")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


def plain(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if pd.api.types.is_datetime64_any_dtype(s):
            text = s.dt.tz_localize(None).astype("datetime64[us]").astype(str)
            df[c] = text.astype(object).where(s.notna(), None)  # the null of every other column without numbers
        elif pd.api.types.is_numeric_dtype(s) and not pd.api.types.is_bool_dtype(s):
            df[c] = s.astype(float)
        else:
            df[c] = [None if v is None or v is pd.NaT or (isinstance(v, float) and np.isnan(v)) else str(v)[:10] if type(v).__name__ in ("date", "Timestamp") else str(v) for v in s]
    return df.sort_values(list(df.columns), na_position="first", kind="stable").reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, db, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    want = db.execute(SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    pd.testing.assert_frame_equal(plain(got), plain(want), check_dtype=False, rtol=0, atol=0)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_model_queries_return_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_without_text_operators(tmp_path):
    """The rest of the library imports and keeps its queries where the text operators are not there."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/aeroledger", tmp_path / "aeroledger", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    for with_pipeline in (True, False):
        folder = tmp_path / str(with_pipeline)
        shutil.copytree(tmp_path / "aeroledger", folder / "aeroledger")
        shutil.copy(f"{root}/__spark_entry__.py", folder)
        if with_pipeline and os.path.exists(f"{root}/corpus_pipeline.py"):
            shutil.copy(f"{root}/corpus_pipeline.py", folder)
        told = subprocess.run(
            [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=folder,
            env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True, check=True).stdout.split()
        own = [name for name in QUERIES if name in entry.registry.QUERIES]
        assert told == [str(len(own)), str(sum(name in SQL for name in own))]


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["rotation_delay", "load_factor", "route_revenue", "dq_suite", "bag_cycle_sla", "delay_actions", "validate_rejects"])
def test_plans_stay_in_the_engine(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for banned in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in plan
    assert "ReadSchema" in plan


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["route_revenue"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "l_comment" not in plan and "l_tax" not in plan.split("ReadSchema", 1)[1]


def test_registered_jobs_are_whole(spark):
    from aeroledger.plans import registry
    from aeroledger.plans.bindings import Tables

    t = Tables(spark, FOLDER)
    forest = registry._delay_scored(t)[2].stages[-1]
    assert forest.getNumTrees == 300 and forest.getOrDefault("maxDepth") == 10
    assert QUERIES["model_tests_all"](spark, FOLDER).select("table_name").distinct().count() == 17
    assert QUERIES["warehouse_load_all"](spark, FOLDER).where("n_rows > 0").count() == 11
    assert QUERIES["dq_gate_fresh"](spark, FOLDER).first().total == 14
    assert QUERIES["profile_all_columns"](spark, FOLDER).first().columns == len(t.raw("lineitem").columns)
    assert sum(name.startswith("staging_") for name in QUERIES) >= 8
    plan = QUERIES["passenger_bookings"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan
